"""Ordering, picking, windows and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scans as SC


def round_robin(df: DataFrame, bucket: str, row_id: str, n: int, reserved: str | None = None, reserve: int = 10) -> DataFrame:
    """n rows: the reserved bucket's first ones, then one row of each bucket in turn; buckets by their first id.

    No bucket gives more than n rows, so all but its first n are cut before anything is ordered across buckets.
    """
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(bucket).orderBy(row_id))).where(F.col("_rn") <= n + reserve)
    ranked = ranked.withColumn("_first", F.min(row_id).over(Window.partitionBy(bucket)))
    ahead = (F.col(bucket) == reserved) & (F.col("_rn") <= reserve) if reserved is not None else F.lit(False)
    turn = F.col("_rn") - F.when(F.col(bucket) == reserved, reserve).otherwise(0) if reserved is not None else F.col("_rn")
    return ranked.orderBy(F.when(ahead, 0).otherwise(1), F.when(ahead, F.col("_rn")).otherwise(turn), "_first").limit(n).drop("_rn", "_first")


def first(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first n rows in that order: each task keeps n at most, so nothing is sorted as a whole."""
    return df.orderBy(*order).limit(n)


def spread(df: DataFrame, bucket: str, row_id: str, order: Column, n: int) -> DataFrame:
    """n rows, one per id, cycling over the buckets in hash order."""
    one = df.withColumn("_k", order).withColumn("_rn", F.row_number().over(Window.partitionBy(row_id).orderBy("_k"))).where("_rn = 1")
    turn = one.withColumn("_turn", F.row_number().over(Window.partitionBy(bucket).orderBy("_k", row_id))).where(F.col("_turn") <= n)
    return turn.orderBy("_turn", bucket).limit(n).drop("_k", "_rn", "_turn")


def stratified(df: DataFrame, stratum: str, order: Column, k: int, row_id: str) -> DataFrame:
    """The first k rows of each stratum in the given order."""
    rank = F.row_number().over(Window.partitionBy(stratum).orderBy(order, row_id))
    return df.withColumn("_rn", rank).where(F.col("_rn") <= k).drop("_rn")


def plan_and_fill(df: DataFrame, name: str, row_id: str, plan: dict[str, int], fillers: list[str]) -> DataFrame:
    """plan[set] rows of each set, then rows of the filler sets up to the plan's total."""
    sets = list(plan)
    wanted = F.coalesce(*[F.when(F.col(name) == s, F.lit(n)) for s, n in plan.items()])
    place = F.coalesce(*[F.when(F.col(name) == s, F.lit(k)) for k, s in enumerate(sets)])
    ranked = df.where(F.col(name).isin(sets)).withColumn("_rn", F.row_number().over(Window.partitionBy(name).orderBy(row_id)))
    ranked = ranked.where(F.col("_rn") <= sum(plan.values()))
    planned = F.col("_rn") <= wanted
    usable = ranked.where(planned | F.col(name).isin(fillers))
    return usable.orderBy(F.when(planned, 0).otherwise(1), place, "_rn").limit(sum(plan.values())).drop("_rn")


def islands(df: DataFrame, run: str, order: list[str], same: Column, size: int = 6) -> DataFrame:
    """df with island (consecutive rows of equal same within run) and chunk (size rows of an island)."""
    return SC.islands(df, [run], [F.col(c) for c in order], same, size)


def until_budget(df: DataFrame, run: str, order: list[Column], size: Column, start: Column, budget: Column) -> DataFrame:
    """Rows of each run until the running size, begun at start, reaches the budget; the row that reaches it stays."""
    return SC.running(df, [run], order, {"_before": size}).where(F.col("_before") + start < budget).drop("_before")


def token_batches(df: DataFrame, length: str, row_id: str, budget: int) -> DataFrame:
    """df's ids with batch: rows in order of length fill a batch while the longest times their number fits the budget.

    The pass runs over the histogram of lengths: rows of one length fill what is
    open up to budget // length rows, then batches of that many.  So one line a
    length says where each of its rows goes; rows of one length are numbered in
    ranges, so no task sees more than a range.
    """
    counts = sorted((r[length], r["_n"]) for r in df.groupBy(length).agg(F.count("*").alias("_n")).collect())
    plan, batch, held = [], -1, 0  # the open batch and its rows
    for size, n in counts:
        most = max(1, budget // max(size, 1))
        free = min(n, max(0, most - held)) if batch >= 0 else 0
        plan.append((size, batch, free, most))
        if n > free:
            full = -(-(n - free) // most)
            batch, held = batch + full, (n - free) - (full - 1) * most
        else:
            held += n
    kinds = dict(df.dtypes)
    lines = df.sparkSession.createDataFrame(plan, f"{length} {kinds[length]}, _batch long, _free long, _most long")
    placed = SC.numbered(df.select(row_id, length), [length], [F.col(row_id)], "_k").join(lines, length)
    later = F.col("_batch") + 1 + F.floor((F.col("_k") - F.col("_free")) / F.col("_most"))
    return placed.select(row_id, length, F.when(F.col("_k") < F.col("_free"), F.col("_batch")).otherwise(later).cast("long").alias("batch"))


def fixed_batches(df: DataFrame, run: str, order: list[str], size: int) -> DataFrame:
    """df with batch: slices of so many rows of a run in that order."""
    return SC.numbered(df, [run], [F.col(c) for c in order], "_place").withColumn("batch", F.floor(F.col("_place") / size)).drop("_place")


def cyclic(index: Column, items: list) -> Column:
    """items[index mod n]."""
    return F.get(F.array(*[F.lit(i) for i in items]), F.pmod(index, F.lit(len(items))).cast("int"))


def weighted_choice(u: Column, weighted: list[tuple]) -> Column:
    """The item whose cumulative share first exceeds u."""
    total, edge, out = float(sum(w for _, w in weighted)), 0.0, None
    for item, weight in weighted[:-1]:
        edge += weight / total
        out = F.when(u < edge, F.lit(item)) if out is None else out.when(u < edge, F.lit(item))
    return out.otherwise(F.lit(weighted[-1][0])) if out is not None else F.lit(weighted[-1][0])


def top_counts(df: DataFrame, keys: list[str], value: str, k: int) -> DataFrame:
    """The k most common values of each key; ties by value."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), value))
    return counts.withColumn("rank", rank).where(F.col("rank") <= k)


def examples(df: DataFrame, name: str, row_id: str, order: Column, plan: list[str], traced: Column, prefer: tuple[str, ...] = ()) -> DataFrame:
    """One row for every entry of the plan, in its order: of each set the first rows in the given order, traced ones
    ahead in the preferred sets; a set that has too few rows leaves its places open."""
    wanted = {s: plan.count(s) for s in plan}
    ahead = F.when(F.col(name).isin(*prefer) & traced, 0).otherwise(1) if prefer else F.lit(1)
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(name).orderBy(ahead, order, row_id)))
    few = ranked.where(F.coalesce(*[F.when(F.col(name) == s, F.lit(n)) for s, n in wanted.items()], F.lit(0)) >= F.col("_rn"))
    places = {s: [k for k, x in enumerate(plan) if x == s] for s in wanted}
    place = F.coalesce(*[F.when(F.col(name) == s, F.get(F.array(*[F.lit(k) for k in ks]), F.col("_rn") - 1)) for s, ks in places.items()])
    return few.withColumn("place", place).drop("_rn")


def diverse(df: DataFrame, domain: str, row_id: str, order: Column, n: int) -> DataFrame:
    """One row a domain, then more up to n, all in the given order."""
    ranked = df.withColumn("_o", order).withColumn("_rn", F.row_number().over(Window.partitionBy(domain).orderBy("_o", row_id))).where(F.col("_rn") <= n)
    return ranked.orderBy(F.when(F.col("_rn") == 1, 0).otherwise(1), "_o", row_id).limit(n).drop("_o", "_rn")


def most_common(df: DataFrame, key: str) -> DataFrame:
    """key, n and rank: values by count, ties by value."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    return SC.numbered(counts, [], [-F.col("n"), F.col(key)], "rank").withColumn("rank", (F.col("rank") + 1).cast("int"))
