"""Exact top-k inner-product search over a pivot-distance index.

Index.  Pivots are fitted on a bounded sample (``SAMPLE`` vectors drawn by a
hash); every vector is keyed by its nearest pivot and by the ring of its
distance to it (``RINGS`` per pivot), and large rings are dealt to blocks of
about ``BLOCK_ROWS`` rows, so that one common vector fills many blocks.

Search.  For a query q and a block around pivot p with distances in [lo, hi] and
norms up to n, the triangle inequality gives

    q.x = q.p + q.(x - p)           <= q.p + |q| hi
    q.x = (|q|^2 + |x|^2 - d^2)/2   <= (|q|^2 + n^2 - gap^2)/2,

gap being how far d(q, p) lies outside [lo, hi].  Blocks are visited in order of
the smaller bound, the most promising annuli first: a first pass scans the best
blocks of each query until they hold enough rows, which gives a floor for its
k-th score; a second pass scans the blocks whose bound reaches that floor, and
no others.  Scores are integers, so the result is exact, ties included.

Each component becomes floor(1024 x), as contracted.  Scores are computed in
doubles where all products stay below 2**53, else in Python integers; a score
beyond 64 bits becomes the nearest 64-bit integer.

Vectors of any length take part: a missing component counts as zero, so the
score of two vectors of different lengths is that of their common components
(an empty vector scores 0), and distances and bounds hold as for padded vectors.
Matrices are built by runs of similar length, so one long vector widens no other.

Rows of a block come before the queries that visit it, and the queries pass as a
stream: a task holds one block and one batch of queries, however many visit.

Edge cases.  Vectors that are null or hold null or non-finite components take no
part, nor do null ids.  Rows that repeat an id are candidates of their own; as
queries, rows of one id with different vectors have results of their own, equal
rows one.  Fewer than k candidates: all of them.  Columns other than vec_id and
embedding are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, saved, shuffle_partitions

SAMPLE = 4096
PIVOTS = 64
RINGS = 8
BLOCK_ROWS = 4096
FIRST_ROWS = 64  # rows that the first pass scans at least, times k
QUERY_ROWS = 1024
SLACK = 1e-9
CELLS = 1 << 21  # numbers of a matrix
LONG = 1 << 63
PIVOT_WIDTH = 1024


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<long>) of the vectors that take part."""
    x = F.col("embedding")
    rows = vectors.where("vec_id is not null and embedding is not null")
    rows = rows.where(~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(F.lit(1024.0) * c.cast("double"))).alias("v"))


def _runs(column: pa.Array, cells: int = CELLS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) of the rows in order of length, padded with zeros, about cells numbers a matrix."""
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    start = np.cumsum(size) - size
    order = np.argsort(size, kind="stable")
    a = 0
    while a < len(order):
        b = a + 1
        # rows of up to twice the length of the first, as many as fit
        limit = max(2 * int(size[order[a]]), 16)
        b = max(b, int(np.searchsorted(size[order], limit, side="right")))
        width = max(1, int(size[order[b - 1]]))
        b = min(b, a + max(1, cells // width))
        rows = order[a:b]
        width = max(1, int(size[rows].max()))
        matrix = np.zeros((len(rows), width), dtype=values.dtype)
        inside = np.arange(width) < size[rows][:, None]
        matrix[inside] = values[(start[rows][:, None] + np.arange(width))[inside]]
        yield rows, matrix
        a = b


def _common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components that both matrices have."""
    width = min(a.shape[1], b.shape[1])
    return a[:, :width], b[:, :width]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of a and b, missing components being zero."""
    a, b = _common(a, b)
    return a @ b.T


def fit_pivots(sample: np.ndarray, n: int, rounds: int = 5) -> np.ndarray:
    """k-means centres; the first ones are spread over the sample by distance."""
    sample = np.unique(sample, axis=0)
    if len(sample) <= n:
        return sample
    chosen = [0]
    gap = ((sample - sample[0]) ** 2).sum(axis=1)
    for _ in range(n - 1):
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    pivots = sample[chosen].copy()
    for _ in range(rounds):
        near = _distances(sample, pivots).argmin(axis=1)
        for k in range(n):
            mine = sample[near == k]
            if len(mine):
                pivots[k] = mine.mean(axis=0)
    return pivots


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    square = (x**2).sum(axis=1)[:, None] + (p**2).sum(axis=1)[None, :] - 2 * _products(x, p)
    return np.sqrt(np.maximum(square, 0))


def _distance(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Distances of rows to rows, without cancellation."""
    near, far = _common(x, p)
    width = near.shape[1]
    return np.sqrt(((near - far) ** 2).sum(axis=1) + (x[:, width:] ** 2).sum(axis=1) + (p[:, width:] ** 2).sum(axis=1))


def _keyed(pivots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots.value
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.num_rows
            near, dist, norm = np.empty(n, dtype=np.int32), np.empty(n), np.empty(n)
            for rows, x in _runs(batch.column("v")):
                x = x.astype(np.float64)
                near[rows] = _distances(x, p).argmin(axis=1)
                dist[rows] = _distance(x, p[near[rows]])
                norm[rows] = np.sqrt((x**2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(near), pa.array(dist), pa.array(norm)], names=["vec_id", "v", "pivot", "dist", "norm"])

    return run


def build_index(vectors: DataFrame, scratch: Scratch, n_pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray, list[dict]]:
    """(rows keyed by pivot, ring and block; pivots; one entry per pivot and ring, a bounded table)."""
    spark = vectors.sparkSession
    rows = scratch.saved(integers(vectors), "vectors")
    rate = min(1.0, SAMPLE / max(1, rows.count()))
    drawn = rows.where(F.pmod(F.xxhash64(F.lit("pivot"), "vec_id"), F.lit(1_000_000)) < int(rate * 1_000_000)).limit(2 * SAMPLE)
    # pivots have the first PIVOT_WIDTH components at most: any pivot gives right bounds
    cut = lambda df: [r["v"] for r in df.select(F.slice("v", 1, PIVOT_WIDTH).alias("v")).collect()]
    found = cut(drawn) or cut(rows.limit(1))
    if not found:
        return rows, np.zeros((0, 0)), []
    sample = np.zeros((len(found), max(1, max(map(len, found)))))
    for row, v in zip(sample, found):
        row[: len(v)] = v
    pivots = fit_pivots(sample, n_pivots)
    keyed = scratch.saved(rows.mapInArrow(_keyed(spark.sparkContext.broadcast(pivots)), "vec_id long, v array<long>, pivot int, dist double, norm double"), "keyed")
    reach = {r["pivot"]: r["m"] for r in keyed.groupBy("pivot").agg(F.max("dist").alias("m")).collect()}
    width = F.element_at(F.create_map(*[F.lit(x) for k, m in reach.items() for x in (k, max(m, 1e-9) / RINGS)]), F.col("pivot"))
    ringed = keyed.withColumn("ring", F.least(F.lit(RINGS - 1), F.floor(F.col("dist") / width).cast("int")))
    cells = [r.asDict() for r in ringed.groupBy("pivot", "ring").agg(F.count("*").alias("n"), F.min("dist").alias("lo"), F.max("dist").alias("hi"), F.max("norm").alias("norm")).collect()]
    cells.sort(key=lambda c: (c["pivot"], c["ring"]))
    for k, c in enumerate(cells):
        c["cell"], c["blocks"] = k, -(-c["n"] // BLOCK_ROWS)
    number = F.create_map(*[F.lit(x) for c in cells for x in (c["pivot"] * RINGS + c["ring"], c["cell"])])
    blocks = F.create_map(*[F.lit(x) for c in cells for x in (c["cell"], c["blocks"])])
    indexed = ringed.withColumn("cell", F.element_at(number, F.col("pivot") * RINGS + F.col("ring")))
    # equal vectors differ in id, and rows of one id in their place in the table
    indexed = indexed.withColumn("block", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.element_at(blocks, F.col("cell")).cast("long")).cast("int"))
    return scratch.saved(indexed.select("cell", "block", "vec_id", "v"), "index"), pivots, cells


def _bounds(q: np.ndarray, pivots: np.ndarray, cells: list[dict]) -> np.ndarray:
    """Upper bounds of the scores of each query in each cell."""
    at = np.array([c["pivot"] for c in cells])
    lo, hi, norm = (np.array([c[k] for c in cells]) for k in ("lo", "hi", "norm"))
    q_norm = np.sqrt((q**2).sum(axis=1))[:, None]
    d = _distances(q, pivots)[:, at]
    gap = np.maximum(0, np.maximum(lo - d, d - hi) - 1e-6 * (1 + d))
    linear = _products(q, pivots)[:, at] + q_norm * hi
    square = (q_norm**2 + norm**2 - gap**2) / 2
    bound = np.minimum(np.minimum(linear, square), q_norm * norm)
    return bound + SLACK * (1 + np.abs(bound)) + 1


def _plan(shared, k: int, first: bool):
    """Rows (cell, block, query, vector) that a pass has to visit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, cells = shared.value
        size = np.array([c["n"] for c in cells])
        n_blocks = np.array([c["blocks"] for c in cells])
        for batch in batches:
            for a in range(0, batch.num_rows, QUERY_ROWS):
                part = batch.slice(a, QUERY_ROWS)
                bound = np.empty((part.num_rows, len(cells)))
                for rows, q in _runs(part.column("v")):
                    bound[rows] = _bounds(q.astype(np.float64), pivots, cells)
                order = np.argsort(-bound, axis=1, kind="stable")
                held = np.cumsum(size[order], axis=1) - size[order]
                begin = held < FIRST_ROWS * k  # the cells before this one hold too few rows
                go = np.zeros(bound.shape, dtype=bool)
                np.put_along_axis(go, order, begin, axis=1)
                if not first:
                    floor = part.column("floor").to_numpy(zero_copy_only=False)
                    go = ~go & (bound >= np.where(np.isnan(floor), -np.inf, floor)[:, None])
                row, cell = np.nonzero(go)
                times = n_blocks[cell]
                row, cell = np.repeat(row, times), np.repeat(cell, times)
                block = np.arange(len(cell)) - np.repeat(np.cumsum(times) - times, times)
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(block.astype(np.int32)), *[part.column(c).take(pa.array(row)) for c in ("vec_id", "q_key", "v")]], names=["cell", "block", "query_id", "q_key", "q"])

    return run


def best(scores: np.ndarray, k: int) -> list[np.ndarray]:
    """Columns of the k highest scores of each row, the first of equal ones."""
    n = scores.shape[1]
    if n <= k:
        return [np.arange(n)] * len(scores)
    kth = np.partition(scores, n - k, axis=1)[:, n - k]
    out = []
    for row, least in zip(scores, kth):
        above = np.flatnonzero(row > least)
        out.append(np.concatenate([above, np.flatnonzero(row == least)[: k - len(above)]]))
    return out


def _scan(k: int):
    """Rows come sorted by (cell, block), those of the index before the queries that visit them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, block = None, [], None
        for batch in batches:
            cell, number = batch.column("cell").to_numpy(), batch.column("block").to_numpy()
            query = batch.column("query_id").is_valid().to_numpy(zero_copy_only=False)
            cut = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]) | (number[1:] != number[:-1]) | (query[1:] != query[:-1])]) if len(cell) else []
            for a, b in zip(cut, [*cut[1:], len(cell)]):
                part = batch.slice(a, b - a)
                if at != (cell[a], number[a]):
                    at, held, block = (cell[a], number[a]), [], None
                if not query[a]:
                    held.append(part)
                elif held:
                    block = block or _block(held)
                    for c in range(0, part.num_rows, QUERY_ROWS):
                        yield from _scores(part.slice(c, QUERY_ROWS), *block, k)

    return run


def _block(parts: list[pa.RecordBatch]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """(ids in ascending order, matrices with the places of their rows)."""
    data = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
    order = pc.sort_indices(data.column("vec_id"))
    data = data.take(order)
    return data.column("vec_id").to_numpy(), list(_runs(data.column("v")))


def _scores(asks: pa.RecordBatch, ids: np.ndarray, runs: list, k: int) -> Iterator[pa.RecordBatch]:
    """The k best rows of a block for each query."""
    q_ids, q_keys = asks.column("query_id").to_numpy(), asks.column("q_key").to_numpy()
    for rows, q in _runs(asks.column("v")):
        pairs = [(at, *_common(q, x)) for at, x in runs]
        largest = max(int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1] for _, a, b in pairs)
        if largest < 1 << 53:
            scores = np.empty((len(rows), len(ids)))
            for at, a, b in pairs:
                scores[:, at] = a.astype(np.float64) @ b.T.astype(np.float64)
            scores[q_ids[rows][:, None] == ids[None, :]] = -np.inf
            got = [(i, j, int(scores[i, j])) for i, js in enumerate(best(scores, k)) for j in js if scores[i, j] > -np.inf]
        else:
            got = []
            for i, own in enumerate(q_ids[rows]):
                found = []
                for at, a, b in pairs:
                    v = a[i].tolist()
                    found += [(-max(-LONG, min(LONG - 1, sum(s * t for s, t in zip(v, c)))), int(j)) for j, c in zip(at, b.tolist()) if ids[j] != own]
                got += [(i, j, -s) for s, j in sorted(found)[:k]]
        if got:
            i, j, s = zip(*got)
            i = rows[list(i)]
            yield pa.RecordBatch.from_arrays([pa.array(q_ids[i]), pa.array(q_keys[i]), pa.array(ids[list(j)]), pa.array(s, pa.int64())], names=["query_id", "q_key", "vec_id", "score"])


def topk(queries: DataFrame, vectors: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best vectors of each row of queries, the row's own id apart."""
    with Scratch(vectors.sparkSession) as scratch:
        return _topk(queries, vectors, k, scratch)


def _topk(queries: DataFrame, vectors: DataFrame, k: int, scratch: Scratch) -> DataFrame:
    spark = vectors.sparkSession
    parts = shuffle_partitions(spark)
    index, pivots, cells = build_index(vectors, scratch)
    empty = "query_id long, rank int, vec_id long, score long"
    if not cells:
        return spark.createDataFrame([], empty)
    shared = spark.sparkContext.broadcast((pivots, cells))
    # q_key tells queries of one id apart
    asks = integers(queries).dropDuplicates(["vec_id", "v"]).withColumn("q_key", F.xxhash64("v"))

    def search(visits: DataFrame) -> DataFrame:
        none = F.lit(None).cast("long")
        rows = index.select("cell", "block", "vec_id", none.alias("query_id"), none.alias("q_key"), "v")
        rows = rows.unionByName(visits.select("cell", "block", none.alias("vec_id"), "query_id", "q_key", F.col("q").alias("v")))
        dealt = rows.repartition(parts, "cell", "block").sortWithinPartitions("cell", "block", F.col("query_id").asc_nulls_first())
        return dealt.mapInArrow(_scan(k), "query_id long, q_key long, vec_id long, score long")

    def ranked(found: DataFrame) -> DataFrame:
        by = Window.partitionBy("query_id", "q_key").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)

    plan = "cell int, block int, query_id long, q_key long, q array<long>"
    near = scratch.saved(ranked(search(asks.mapInArrow(_plan(shared, k, True), plan))), "near")
    floors = near.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), "q_key", F.col("score").cast("double").alias("floor"))
    rest = asks.join(floors, ["vec_id", "q_key"], "left").select("vec_id", "q_key", "v", "floor")
    far = search(rest.mapInArrow(_plan(shared, k, False), plan))
    return saved(ranked(near.drop("rank").unionByName(far)).select("query_id", "rank", "vec_id", "score"), "topk")


def op6_topk_search(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return topk(vectors.where(F.col("vec_id") % 100 == 0), vectors)


ORACLE = """
WITH v AS (
  SELECT vec_id::BIGINT AS vec_id, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), q AS (SELECT DISTINCT vec_id, v FROM v WHERE vec_id % 100 = 0
), s AS (
  SELECT q.vec_id AS query_id, q.v, x.vec_id, coalesce(list_sum(list_transform(list_zip(q.v, x.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM q JOIN v x ON q.vec_id <> x.vec_id
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id, v ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
) WHERE rank <= 10
"""
