"""Running numbers and sums over an order, in many tasks whatever one key holds.

Rows are dealt to ranges of (keys, order) and written down, so that the ranges
hold for all that follows.  A range adds up what it has of each key; the sums of
the ranges before it (one line a range and key, so few lines a key) are joined
back, and inside its range each row is numbered by a window.  No task sees more
of a key than a range holds, provided that the order tells rows apart: ties beyond
it are broken by a hash of the row, and equal rows may come in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dedup import require_shared_dir

_RANGE = "_range"


def _ranged(df: DataFrame, keys: list[str], order: list[Column]) -> tuple[DataFrame, list[str], list[str]]:
    """(df with its range, key columns, order columns): keys and order as columns of their own, which expressions may be."""
    require_shared_dir(df)
    named = {f"_k{i}": F.col(k) for i, k in enumerate(keys)} | {f"_o{i}": o for i, o in enumerate(order)}
    own = df.withColumns(named).withColumn("_tie", F.xxhash64(*df.columns))
    k, o = [f"_k{i}" for i in range(len(keys))], [*[f"_o{i}" for i in range(len(order))], "_tie"]
    return own.repartitionByRange(*k, *o).withColumn(_RANGE, F.spark_partition_id()).checkpoint(), k, o


def _joined(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """left with the line of right of its keys, which may be null."""
    same = F.lit(True)
    for c in columns:
        same = same & left[c].eqNullSafe(right[c])
    return left.join(right, same).drop(*[right[c] for c in columns])


def running(df: DataFrame, keys: list[str], order: list[Column], sums: dict[str, Column], place: str | None = None) -> DataFrame:
    """df with place, the row's number from 0 within its keys in that order, and each of sums over the rows before it (0 for the first)."""
    values = {f"_v{i}": F.coalesce(v, F.lit(0)) for i, v in enumerate(sums.values())}
    rows, k, o = _ranged(df.withColumns(values) if values else df, keys, order)
    parts = rows.groupBy(_RANGE, *k).agg(F.count("*").alias("_n"), *[F.sum(v).alias(f"_s{i}") for i, v in enumerate(values)])
    before = Window.partitionBy(*k).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    parts = parts.select(_RANGE, *k, so_far("_n").alias("_before"), *[so_far(f"_s{i}").alias(f"_b{i}") for i in range(len(values))])
    inside = Window.partitionBy(_RANGE, *k).orderBy(*o)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    out = _joined(rows, parts, [_RANGE, *k])
    found = {} if place is None else {place: F.col("_before") + F.row_number().over(inside) - 1}
    found |= {name: F.col(f"_b{i}") + F.coalesce(F.sum(f"_v{i}").over(earlier), F.lit(0)) for i, name in enumerate(sums)}
    kept = [c for c in df.columns if c not in found]
    return out.select(*kept, *[v.alias(c) for c, v in found.items()])


def numbered(df: DataFrame, keys: list[str], order: list[Column], place: str) -> DataFrame:
    return running(df, keys, order, {}, place)


def zipped(left: DataFrame, right: DataFrame, left_order: list[Column], right_order: list[Column], place: str = "place") -> DataFrame:
    """Rows of both sides that have the same place in their orders, as long as the shorter side goes; column names must differ."""
    return numbered(left, [], left_order, place).join(numbered(right, [], right_order, place), place)


def islands(df: DataFrame, run: list[str], order: list[Column], same: Column, size: int) -> DataFrame:
    """df with island (from 1: consecutive rows of equal same within a run) and chunk (from 0: so many rows of an island).

    A range knows the islands that begin inside it; whether its first row begins
    one is for the last row of the range before it to say, and where an island
    began comes down from the last range that began one.
    """
    rows, k, o = _ranged(df.withColumn("_same", same), run, order)
    inside = Window.partitionBy(_RANGE, *k).orderBy(*o)
    at = F.row_number().over(inside) - 1
    marked = rows.withColumns({"_at": at, "_new": (F.row_number().over(inside) > 1) & ~F.col("_same").eqNullSafe(F.lag("_same").over(inside))})
    first = F.struct("_at", "_same")
    parts = marked.groupBy(_RANGE, *k).agg(
        F.count("*").alias("_n"), F.count_if("_new").alias("_begun"), F.min(first)["_same"].alias("_first"), F.max(first)["_same"].alias("_last"), F.max(F.when(F.col("_new"), F.col("_at"))).alias("_newest")
    )
    over = Window.partitionBy(*k).orderBy(_RANGE)
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns({"_opens": (F.row_number().over(over) == 1) | ~F.col("_first").eqNullSafe(F.lag("_last").over(over)), "_rows": F.coalesce(F.sum("_n").over(before), F.lit(0))})
    newest = F.col("_rows") + F.coalesce("_newest", F.when(F.col("_opens"), 0))  # where the island began that is open at the range's end
    parts = parts.withColumns({"_islands": F.coalesce(F.sum(F.col("_begun") + F.col("_opens").cast("int")).over(before), F.lit(0)), "_open_at": newest})
    parts = parts.withColumn("_carried", F.last("_open_at", ignorenulls=True).over(before))
    begin = F.when(F.col("_opens"), F.col("_rows")).otherwise(F.col("_carried"))
    parts = parts.select(_RANGE, *k, (F.col("_islands") + F.col("_opens").cast("int")).alias("_island"), "_rows", begin.alias("_begin"))
    out = _joined(marked, parts, [_RANGE, *k])
    place = F.col("_rows") + F.col("_at")
    began = F.coalesce(F.max(F.when(F.col("_new"), F.col("_rows") + F.col("_at"))).over(inside), F.col("_begin"))
    return out.select(*df.columns, (F.col("_island") + F.count_if("_new").over(inside)).alias("island"), F.floor((place - began) / size).alias("chunk"))
