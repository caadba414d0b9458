"""Quality rules with compression bands.

Base rules: word, symbol, repeated-line and repeated-window counts of the whole
text.  Method: zstandard ratios (bytes before / bytes after) of the whole text
and of its fixed chunks must lie in a band that depends on the length; text
below the band is close to random (encoded or enciphered data), text above it
repeats itself.  A text passes the chunk rule while at most ``CHUNK_SHARE`` of
its bytes are in chunks out of the band.  The last chunk is what is left, judged
by the band of its length.

Edge cases.  Null counts as the empty text: zero counts, base_failed and not
kept.  Texts shorter than the first band have no compression verdict; a tail
as short as that is judged with the chunk before it.  Rows are independent, so repeated
rows get equal results, and a null doc_id stays null.  Input columns named like
a result column are replaced.

SQL can express the base counts (``ORACLE``, held against them in the tests) but
not the compression verdict, so the query has no registered SQL.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from . import textcore as T
from .common import widened, without

#: (from this many bytes, least ratio, greatest ratio) of whole texts.  The least ratios lie between base64 or random
#: letters and digits, which reach 1.16 to 1.39 at the end of a band, and prose; hexadecimal digits (1.6 to 1.9) pass.
BANDS = (
    (0, 0.0, float("inf")),
    (256, 1.17, 3.0),
    (320, 1.2, 3.0),
    (384, 1.25, 3.0),
    (512, 1.3, 3.0),
    (768, 1.34, 3.0),
    (1024, 1.4, 3.5),
    (2048, 1.43, 3.5),
    (4096, 1.45, 4.5),
    (16384, 1.5, 6.0),
    (131072, 1.5, 8.0),
)
CHUNK = 4096
CHUNK_BAND = (1.45, 4.0)
CHUNK_SHARE = 0.3
#: Bytes from which there is a compression verdict.
SHORTEST = BANDS[1][0]
LEVEL = 3
#: Base rules.
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of words
SYMBOLS = b"#*$%&|<>"
WINDOW = 3

CHUNK_BYTES = (1 << 20) - 1
RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "bad_chunk_share", "reason")

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Counts of flags in each interval between the offsets at."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[at])


def _keyed(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return T.mix(h ^ (doc.astype(np.uint64) * _SPREAD))


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    s = np.sort(keys)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(twice):
        return np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def _duplicate_lines(w: T.Words) -> np.ndarray:
    newline = np.flatnonzero(w.data == 0x0A)
    start = np.unique(np.concatenate([w.doc_byte[:-1][np.diff(w.doc_byte) > 0], newline + 1]))
    start = start[start < len(w.data)]
    # up to the next newline, which may be the first byte, or to the end of the document, which may not
    stop = np.append(newline, len(w.data))[np.searchsorted(newline, start)]
    end = np.minimum(stop, w.doc_byte[np.searchsorted(w.doc_byte, start, side="right")])
    filled = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end = start[filled], end[filled]
    doc = np.searchsorted(w.doc_byte, start, side="right") - 1
    lines = T.Words(w.data, w.doc_byte, start, end, w.doc_word)
    keys = _keyed(T.word_hashes(lines), doc)
    order = np.argsort(keys, kind="stable")
    again = np.flatnonzero(keys[order][1:] == keys[order][:-1]) + 1
    return np.bincount(doc[order[again]], minlength=w.n_docs)


def base_counts(w: T.Words) -> dict[str, np.ndarray]:
    """The base counts of each document."""
    n_words = w.counts()
    inside = np.zeros(len(w.data) + 1, dtype=np.int8)
    inside[w.start] += 1
    np.subtract.at(inside, w.end, 1)
    leads = (np.cumsum(inside[:-1], dtype=np.int8) > 0) & ((w.data & 0xC0) != 0x80)
    starts = T.window_starts(w, WINDOW)
    doc_of = w.doc_of()
    again = starts[_repeated(_keyed(T.window_hashes(T.word_hashes(w), starts, WINDOW), doc_of[starts]))]
    cover = np.zeros(len(w.start), dtype=bool)
    for k in range(WINDOW):
        cover[again + k] = True
    return {
        "n_words": n_words,
        "word_chars": _sums(leads, w.doc_byte),
        "n_symbols": _sums(_SYMBOL[w.data], w.doc_byte),
        "n_dup_lines": _duplicate_lines(w),
        "n_repeat_words": _sums(cover, w.doc_word),
    }


def _band(size: int) -> tuple[int, float, float]:
    return next(b for b in reversed(BANDS) if size >= b[0])


def compression(data: bytes, compressor: zstandard.ZstdCompressor) -> tuple[float | None, float | None, str | None]:
    """(ratio of the whole, share of chunk bytes out of the band, reason to reject)."""
    if not data:
        return None, None, None
    ratio = len(data) / len(compressor.compress(data))
    _, least, most = _band(len(data))
    reason = "incompressible" if ratio < least else "repetitive" if ratio > most else None
    share = None
    if len(data) >= SHORTEST:
        # a tail without a band of its own belongs to the chunk before it
        starts = range(0, len(data) - SHORTEST + 1, CHUNK)
        bad = 0
        for x, y in zip(starts, [*starts[1:], len(data)]):
            _, low, high = _band(y - x)
            low, high = CHUNK_BAND if y - x >= CHUNK else (low, high)
            bad += (y - x) * (not low <= (y - x) / len(compressor.compress(data[x:y])) <= high)
        share = bad / len(data)
        if reason is None and share > CHUNK_SHARE:
            reason = "chunks"
    return ratio, share, reason


def _rules(fields: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            texts = T.strings(batch.column("text"))
            for a, b in T.slices(texts, CHUNK_BYTES):
                w = T.words(texts.slice(a, b - a))
                counts = base_counts(w)
                data = w.data.tobytes()
                verdicts = [compression(data[x:y], compressor) for x, y in zip(w.doc_byte.tolist(), w.doc_byte[1:].tolist())]
                failed = (counts["n_words"] < LEAST_WORDS) | (100 * counts["n_repeat_words"] > MOST_REPEATED * counts["n_words"])
                kept = ~failed & np.array([v[2] is None for v in verdicts], dtype=bool)
                columns = [batch.column(f).slice(a, b - a) for f in fields]
                columns += [pa.array(c.astype(np.int64)) for c in counts.values()] + [pa.array(failed), pa.array(kept)]
                columns += [pa.array([v[0] for v in verdicts], pa.float64()), pa.array([v[1] for v in verdicts], pa.float64()), pa.array([v[2] for v in verdicts], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*fields, *RESULT])

    return run


def quality_rules(docs: DataFrame) -> DataFrame:
    """docs with the base counts, base_failed, kept, ratio, bad_chunk_share and the reason of the compression verdict."""
    docs = without(docs, RESULT)
    kinds = ["long"] * 5 + ["boolean"] * 2 + ["double"] * 2 + ["string"]
    return docs.mapInArrow(_rules(docs.columns), widened(docs, zip(RESULT, kinds)))


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality_rules(docs).drop("text")


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM t),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
k AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM k WHERE n > 1) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
  (len(ws) < 50 OR 100 * coalesce(r.n, 0) > 50 * len(ws)) AS base_failed
FROM w LEFT JOIN r USING (doc_id)
"""
