"""Streams of sorted Arrow batches, cut into the groups of their key columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def _changes(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    n = batch.num_rows
    new = np.zeros(n, dtype=bool)
    new[0] = True
    for key in keys:
        column = batch.column(key)
        new[1:] |= pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, n - 1)), False).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches come sorted by the keys, none of which is null; each group comes out as one batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        first = _changes(batch, keys)
        same = bool(held) and all(held[-1].column(k)[-1].as_py() == batch.column(k)[0].as_py() for k in keys)
        if held and not same:
            yield _joined(held)
            held = []
        for a, b in zip(first, [*first[1:], batch.num_rows]):
            part = batch.slice(a, b - a)
            if b < batch.num_rows:
                yield _joined([*held, part])
                held = []
            else:
                held.append(part)
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
