"""Substring deduplication by difference-cover anchors.

Contract.  A window is ``window`` consecutive words of one document.  A word
goes if a window that covers it holds the same word sequence as a window of a
document with a smaller doc_id.  Windows are judged on the input.

Method.  With a difference cover D modulo p, any two positions i, j have a
shift s < p with i + s and j + s both at cover positions.  So two equal windows
share an *anchor*: a run of ``window - p + 1`` words that begins at a cover
position of both documents.  Only anchors are hashed and shuffled (6 in 31
positions); an anchor that two documents share is then extended: the windows
around it, and only those, are hashed with 96 bits and compared.

Skew.  Both shuffles are pre-aggregated by chunks of text: an anchor that
several documents of a chunk hold is settled inside the chunk and leaves it as
one row, and of equal windows only those of the smallest doc_id leave a chunk.
So a passage that a third of all documents hold costs one row a chunk, and the
sorted groups are read as a stream, never held.

Edge cases.  Null or empty text: no words, nothing removed, the hash of the
empty text.  Fewer than ``window`` words: nothing removed.  Null doc_id: kept
whole and never a source.  Repeated rows of one doc_id: each is judged against
smaller ids only.  Input columns named like a result column are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from . import textcore as T
from .common import shuffle_partitions, without

#: A perfect difference set modulo 31.
COVER_PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)

CHUNK_BYTES = 3 << 20
RESULT = ("n_words", "n_removed", "kept_sha256", "kept_text")

# meta packs th (29 bits), pos (32) and kind (2): every field of a shuffled row costs eight bytes before compression.
_ROWS = "h1 long, h2 int, doc_id long, meta long, many binary"
_ARROW = pa.schema([("h1", pa.int64()), ("h2", pa.int32()), ("doc_id", pa.int64()), ("meta", pa.int64()), ("many", pa.binary())])
_FOUND = "doc_id long, th int, many binary"
_FOUND_ARROW = pa.schema([("doc_id", pa.int64()), ("th", pa.int32()), ("many", pa.binary())])

ONE, SHARED, LOCAL = 0, 1, 2


def _blobs(doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """Positions as little-endian int32 bytes for each document index."""
    order = np.lexsort((pos, doc))
    doc, pos = doc[order], pos[order].astype("<i4")
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, dtype=np.int64)
    cut = [*first.tolist(), len(doc)]
    return doc[first], [pos[a:b].tobytes() for a, b in zip(cut, cut[1:])]


def _batch(parts: list[tuple]) -> pa.RecordBatch:
    """parts: (h1, h2, kind, doc_id, th, pos, many or None) columns."""
    h1, h2, kind, doc_id, th, pos = (np.concatenate([np.asarray(p[i]) for p in parts]) for i in range(6))
    meta = th.astype(np.int64) << 34 | pos.astype(np.int64) << 2 | kind
    many = [x for p in parts for x in (p[6] if p[6] is not None else [None] * len(p[0]))]
    return pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), pa.array(doc_id), pa.array(meta), pa.array(many, type=pa.binary())], schema=_ARROW)


def _local(ids: np.ndarray, th: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple:
    docs, blobs = _blobs(doc, pos)
    n = len(docs)
    spread = T.mix(ids[docs].astype(np.uint64)).astype(np.int64)
    return spread, np.zeros(n, np.int32), np.full(n, LOCAL, np.int8), ids[docs], th[docs], np.zeros(n, np.int32), blobs


def _chunks(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        texts = T.strings(batch.column("text"))
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        th = batch.column("th").to_numpy(zero_copy_only=False)
        for a, b in T.slices(texts, CHUNK_BYTES):
            yield T.words(texts.slice(a, b - a)), ids[a:b], th[a:b], batch.slice(a, b - a)


def _anchors(window: int):
    width = window - COVER_PERIOD + 1
    cover = np.zeros(COVER_PERIOD, dtype=bool)
    cover[list(COVER)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w, ids, th, _ in _chunks(batches):
            starts = T.window_starts(w, width)
            if not len(starts):
                continue
            doc = w.doc_of()[starts]
            pos = starts - w.doc_word[doc]
            keep = cover[pos % COVER_PERIOD]
            starts, doc, pos = starts[keep], doc[keep], pos[keep]
            if not len(starts):
                continue
            h = T.window_hashes(T.word_hashes(w), starts, width)
            order = np.argsort(h, kind="stable")  # documents stay in order within a hash
            h, doc, pos = h[order], doc[order], pos[order]
            new = np.r_[True, h[1:] != h[:-1]]
            first = np.flatnonzero(new)
            last = np.r_[first[1:], len(h)] - 1
            shared = (doc[first] != doc[last])
            of = np.cumsum(new) - 1
            one = ~shared[of]
            # in text order, as rows of one document compress well side by side
            text_order = np.flatnonzero(one)[np.argsort(order[one])]
            m = len(text_order)
            parts = [(h[text_order].view(np.int64), np.zeros(m, np.int32), np.full(m, ONE, np.int8), ids[doc[text_order]], th[doc[text_order]], pos[text_order].astype(np.int32), None)]
            if shared.any():
                n = int(shared.sum())
                zero = np.zeros(n, np.int32)
                parts.append((h[first[shared]].view(np.int64), zero, np.full(n, SHARED, np.int8), zero.astype(np.int64), zero, zero, None))
                parts.append(_local(ids, th, doc[~one], pos[~one]))
            yield _batch(parts)

    return run


def _found(ids: np.ndarray, th: np.ndarray, pos: np.ndarray, kept: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Positions found, and the LOCAL rows of the batch as they are."""
    if kept.num_rows:
        yield kept
    if len(ids):
        data = np.ascontiguousarray(pos, dtype="<i4").view(np.uint8)
        offsets = np.arange(len(ids) + 1, dtype=np.int32) * 4
        many = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(th), many], schema=_FOUND_ARROW)


def _split(batch: pa.RecordBatch):
    """(LOCAL rows as found ones; h1, h2, kind, doc_id, th, pos of the others)."""
    h1, h2, ids, meta = (batch.column(c).to_numpy() for c in ("h1", "h2", "doc_id", "meta"))
    kind, pos, th = (meta & 3).astype(np.int8), (meta >> 2 & 0xFFFFFFFF).astype(np.int32), (meta >> 34).astype(np.int32)
    at = kind == LOCAL
    local = pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(th[at]), batch.column("many").filter(pa.array(at))], schema=_FOUND_ARROW)
    rest = ~at
    return local, h1[rest], h2[rest], kind[rest], ids[rest], th[rest], pos[rest]


def _shared_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by hash; those of a hash that two documents hold go on."""
    held: list[np.ndarray] = []  # rows of a last hash of which one document is known so far
    known = None  # a last hash known to be shared
    for batch in batches:
        local, h, _, kind, ids, th, pos = _split(batch)
        if held:
            h, kind, ids, th, pos = (np.concatenate(x) for x in zip(held, (h, kind, ids, th, pos)))
            held = []
        if not len(h):
            yield from _found(ids, th, pos, local)
            continue
        new = np.r_[True, h[1:] != h[:-1]]
        first = np.flatnonzero(new)
        of = np.cumsum(new) - 1
        one = kind == ONE
        other = (~one) | (ids != ids[first][of]) | (th != th[first][of]) | ~one[first][of]
        shared = np.zeros(len(first), dtype=bool)
        shared[of[other]] = True
        if known is not None and h[0] == known:
            shared[0] = True
        go = shared[of] & one
        if shared[-1]:
            known = h[-1]
        else:
            known = None
            tail = slice(first[-1], None)
            held = [h[tail], kind[tail], ids[tail], th[tail], pos[tail]]
        yield from _found(ids[go], th[go], pos[go], local)


def _positions(blobs) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype="<i4").astype(np.int64)


def _windows(window: int):
    """Hash the windows around the shared anchors of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w, ids, th, batch in _chunks(batches):
            marks = np.zeros(len(w.start) + 1, dtype=np.int64)
            for k, blobs in enumerate(batch.column("found").to_pylist()):
                at = _positions(blobs) + w.doc_word[k]
                at = at[at < w.doc_word[k + 1]]
                np.add.at(marks, np.maximum(at - (COVER_PERIOD - 1), w.doc_word[k]), 1)
                np.add.at(marks, at + 1, -1)
            near = np.cumsum(marks)[:-1] > 0
            starts = T.window_starts(w, window)
            starts = starts[near[starts]]
            if not len(starts):
                continue
            doc = w.doc_of()[starts]
            pos = starts - w.doc_word[doc]
            h1 = T.window_hashes(T.word_hashes(w), starts, window)
            h2 = (T.window_hashes(T.word_hashes(w, 1), starts, window) >> np.uint64(32)).astype(np.uint32)
            order = np.lexsort((pos, ids[doc], h2, h1))
            h1, h2, doc, pos = h1[order], h2[order], doc[order], pos[order]
            new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
            least = ids[doc][np.flatnonzero(new)][np.cumsum(new) - 1]
            one = ids[doc] == least
            text_order = np.flatnonzero(one)[np.argsort(order[one])]
            n = len(text_order)
            parts = [(h1[text_order].view(np.int64), h2[text_order].view(np.int32), np.full(n, ONE, np.int8), ids[doc[text_order]], th[doc[text_order]], pos[text_order].astype(np.int32), None)]
            if n < len(one):
                parts.append(_local(ids, th, doc[~one], pos[~one]))
            yield _batch(parts)

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by hash and doc_id; those after the smallest doc_id of a hash go on."""
    last: tuple | None = None
    for batch in batches:
        local, h1, h2, _, ids, th, pos = _split(batch)
        if not len(h1):
            yield from _found(ids, th, pos, local)
            continue
        new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        least = ids[np.flatnonzero(new)]
        if last is not None and (h1[0], h2[0]) == last[:2]:
            least[0] = last[2]
        go = ids > least[np.cumsum(new) - 1]
        last = (h1[-1], h2[-1], least[-1])
        yield from _found(ids[go], th[go], pos[go], local)


def _cut(data: bytes, w: T.Words, gone: np.ndarray) -> str:
    """The text less the words marked, each with the white space that follows it."""
    change = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
    at, out = 0, []
    for a, b in zip(change[::2], change[1::2]):
        out.append(data[at : w.start[a]])
        at = w.start[b] if b < len(w.start) else len(data)
    out.append(data[at:])
    return b"".join(out).decode()


def _finish(window: int, fields: list[str], texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, digests, kept = [], [], [], []
            found = batch.column("found").to_pylist()
            for text, blobs in zip(batch.column("text"), found):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                split = data.split()
                n = len(split)
                gone = None
                if blobs:
                    marks = np.zeros(n + 1, dtype=np.int64)
                    at = np.unique(_positions(blobs))
                    at = at[at + window <= n]
                    marks[at] += 1
                    marks[at + window] -= 1
                    gone = np.cumsum(marks)[:-1] > 0
                    split = [x for x, g in zip(split, gone.tolist()) if not g]
                counts.append(n)
                removed.append(n - len(split))
                digests.append(hashlib.sha256(b" ".join(split)).hexdigest())
                if texts:
                    kept.append((data.decode() if text.is_valid else None) if gone is None else _cut(data, T.words(pa.array([data.decode()], pa.large_string())), gone))
            columns = [batch.column(c) for c in fields] + [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            names = [*fields, "n_words", "n_removed", "kept_sha256"]
            if texts:
                columns.append(pa.array(kept, pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def substring_dedup(docs: DataFrame, window: int = 50, texts: bool = True) -> DataFrame:
    """docs with n_words, n_removed, kept_sha256 and, if texts, kept_text: the text less its repeated passages."""
    if window < COVER_PERIOD:
        raise ValueError(f"window must be {COVER_PERIOD} words or more")
    n = shuffle_partitions(docs.sparkSession)
    docs = without(docs, RESULT)
    text_hash = F.pmod(F.hash("text"), F.lit(1 << 29))  # tells rows of one doc_id apart
    inner = docs.select("doc_id", F.col("text"), text_hash.alias("th")).where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    anchors = inner.mapInArrow(_anchors(window), _ROWS)
    shared = anchors.repartition(n, "h1").sortWithinPartitions("h1").mapInArrow(_shared_anchors, _FOUND)
    # One exchange of the texts serves both joins: the two branches are the same plan,
    # as the key, a hash of the id and of the text's hash, is never null and needs no filter.
    key = lambda h: F.xxhash64("doc_id", h)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rest = [F.struct(*[F.col(f"`{c}`") for c in others]).alias("rest")] if others else []
    dealt = docs.select("doc_id", "text", *rest, text_hash.alias("th"), key(text_hash).alias("key")).repartition(n, "key")
    by_doc = lambda df: df.groupBy(key("th").alias("key")).agg(F.collect_list("many").alias("found"))
    near = dealt.join(by_doc(shared), "key")
    windows = near.mapInArrow(_windows(window), _ROWS)
    repeated = windows.repartition(n, "h1").sortWithinPartitions("h1", "h2", "doc_id").mapInArrow(_repeated, _FOUND)
    joined = dealt.join(by_doc(repeated), "key", "left")
    fields = ["doc_id", "text", *(["rest"] if others else [])]
    schema = ST.StructType([*[joined.schema[c] for c in fields], ST.StructField("n_words", ST.LongType()), ST.StructField("n_removed", ST.LongType()), ST.StructField("kept_sha256", ST.StringType())] + ([ST.StructField("kept_text", ST.StringType())] if texts else []))
    done = joined.mapInArrow(_finish(window, fields, texts), schema)
    return done.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"rest.`{c}`").alias(c) for c in docs.columns], *schema.names[len(fields) :])


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return substring_dedup(docs, texts=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 49], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50)),
f AS (SELECT k, min(doc_id) AS first FROM g GROUP BY k),
s AS (SELECT doc_id, i FROM g JOIN f USING (k) WHERE first < doc_id),
r AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p FROM s)),
x AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d),
k AS (SELECT x.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY x.p) AS kept FROM x LEFT JOIN r ON x.doc_id = r.doc_id AND x.p = r.p WHERE r.p IS NULL GROUP BY x.doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""
