"""Packing by optimal length buckets.

The global histogram of token lengths is cut into at most ``buckets`` intervals
by dynamic programming so that the padding (every document padded to the
longest length of its bucket) is least.  Inside a bucket, batches are filled up
to a token budget: ``budget // bucket_len`` documents each, one at least.

The histogram has one cell a distinct length, so the cuts are the optimum of the
true lengths; it grows with the lengths that occur, not with the documents.  The
programme runs on the driver in time linear in cells and buckets: with the cells
in order of length the cost of a last interval is a line in the length that ends
it, and the lines' slopes only fall, so a lower hull of them is kept.  A bucket
is dealt to shards of about ``SHARD_ROWS`` documents by a hash of the id and the
row's place in the table, so that no task orders more than that; each shard
leaves at most one batch unfilled.

Edge cases.  Null and empty texts have one token, the end id.  Documents longer
than the budget are batches of their own.  Ties in length are ordered by doc_id;
repeated rows and rows without an id are packed like others.  An empty table
gives no rows.  Columns of lengths that are named like a result column are
replaced; documents' columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, without
from .unit_encoder import encoded

BUCKETS = 16
BUDGET = 65_536
SHARD_ROWS = 4096
TEXT_BYTES = 1 << 20
RESULT = ("n_tokens", "bucket", "bucket_len", "batch_id", "slot", "n_padding")


def _lengths(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, _, lengths in encoded(batch.column("text"), vocabulary, TEXT_BYTES):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(lengths + 1, pa.int64())], names=["doc_id", "n_tokens"])

    return run


def token_lengths(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens) with the end id counted."""
    return docs.select("doc_id", "text").mapInArrow(_lengths(vocabulary), "doc_id long, n_tokens long")


def best_cuts(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Ends (exclusive) of the intervals of least padding, for cells in order of length; exact in integers.

    With c and s the running counts and sums, an interval of the cells i to j - 1 costs L c(j) - s(j) + (s(i) - L c(i)),
    L being the length of cell j - 1: for given L the best i is the lowest of the lines best(i) + s(i) - L c(i).
    """
    n = len(lengths)
    c, s = [0], [0]
    for length, count in zip(lengths, counts):
        c.append(c[-1] + count)
        s.append(s[-1] + count * length)
    best: list[int | None] = [0] + [None] * n
    back = []
    for _ in range(min(buckets, n)):
        now: list[int | None] = [0] + [None] * n
        come = [0] * (n + 1)
        hull: list[tuple[int, int, int]] = []  # (slope, intercept, i); slopes fall, so later lines win for greater lengths
        at = 0
        for j in range(1, n + 1):
            if best[j - 1] is not None:
                line = (-c[j - 1], best[j - 1] + s[j - 1], j - 1)
                while len(hull) > 1 and _hidden(hull[-2], hull[-1], line):
                    hull.pop()
                hull.append(line)
                at = min(at, len(hull) - 1)
            length = lengths[j - 1]
            value = lambda k: hull[k][0] * length + hull[k][1]  # noqa: B023, E731
            while at + 1 < len(hull) and value(at + 1) <= value(at):
                at += 1
            now[j] = value(at) + length * c[j] - s[j]
            come[j] = hull[at][2]
        best = now
        back.append(come)
    cuts, j = [], n
    for come in reversed(back):
        if j == 0:
            break
        cuts.append(j)
        j = come[j]
    return cuts[::-1]


def _hidden(a: tuple[int, int, int], b: tuple[int, int, int], c: tuple[int, int, int]) -> bool:
    """Whether b is nowhere below both a and c; slopes fall from a to c."""
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def pack(lengths: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """lengths(doc_id, n_tokens) with bucket, bucket_len, batch_id, slot and n_padding."""
    lengths = without(lengths, RESULT[1:])
    rows = sorted((r["n_tokens"], r["n"]) for r in lengths.groupBy("n_tokens").agg(F.count("*").alias("n")).collect())
    kinds = "bucket int, bucket_len long, capacity long, shards long"
    plan, first = [], 0
    for k, end in enumerate(best_cuts([r[0] for r in rows], [r[1] for r in rows], buckets)):
        size = rows[end - 1][0]
        capacity = max(1, budget // max(size, 1))
        held = max(1, SHARD_ROWS // capacity) * capacity
        plan.append((k, size, capacity, -(-sum(r[1] for r in rows[first:end]) // held)))
        first = end
    bounds = F.array(*[F.lit(p[1]).cast("long") for p in plan]) if plan else F.lit(None).cast("array<long>")
    table = F.array(*[F.struct(F.lit(k).alias("bucket"), F.lit(size).cast("long").alias("bucket_len"), F.lit(cap).cast("long").alias("capacity"), F.lit(sh).cast("long").alias("shards")) for k, size, cap, sh in plan]) if plan else F.lit(None).cast(f"array<struct<{kinds.replace(' int', ':int').replace(' long', ':long')}>>")
    at = F.size(F.filter(bounds, lambda b: b < F.col("n_tokens")))
    placed = lengths.withColumn("_p", F.get(table, at)).withColumn("_shard", F.pmod(F.xxhash64("doc_id", "n_tokens", F.monotonically_increasing_id()), F.col("_p.shards")))
    order = Window.partitionBy(F.col("_p.bucket"), "_shard").orderBy("n_tokens", "doc_id")
    placed = placed.withColumn("_k", F.row_number().over(order) - 1)
    return placed.select(
        *lengths.columns,
        F.col("_p.bucket").alias("bucket"),
        F.col("_p.bucket_len").alias("bucket_len"),
        F.concat_ws("-", F.col("_p.bucket"), "_shard", F.floor(F.col("_k") / F.col("_p.capacity"))).alias("batch_id"),
        (F.col("_k") % F.col("_p.capacity")).cast("int").alias("slot"),
        (F.col("_p.bucket_len") - F.col("n_tokens")).alias("n_padding"),
    )


def pack_documents(docs: DataFrame, vocabulary: str, buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """(doc_id, n_tokens, bucket, bucket_len, batch_id, slot, n_padding) for every row of docs."""
    return pack(saved(token_lengths(docs, vocabulary), "lengths"), buckets, budget)


def op10_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
