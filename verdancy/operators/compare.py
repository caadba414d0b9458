"""Comparison tables of models: joins, deltas, winners."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TIE = 1e-9


def deltas(ours: DataFrame, base: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Both results and their differences on common keys."""
    left = ours.select(*keys, *[F.col(m).alias(f"{m}_ours") for m in metrics])
    right = base.select(*keys, *[F.col(m).alias(f"{m}_base") for m in metrics])
    return left.join(right, keys).select(*keys, *[c for m in metrics for c in (F.col(f"{m}_ours"), F.col(f"{m}_base"), (F.col(f"{m}_ours") - F.col(f"{m}_base")).alias(f"{m}_delta"))])


def listed(names: list[str], name: str, results: DataFrame, base: DataFrame) -> DataFrame:
    """A fixed list of probes with the values of both sides, null where there is none."""
    spark = results.sparkSession
    order = spark.createDataFrame(list(enumerate(names)), f"place int, {name} string")
    return order.join(results.withColumnRenamed("value", "ours"), name, "left").join(base.withColumnRenamed("value", "base"), name, "left")


def side_by_side(results: DataFrame, row: str, model: str, value: str, models: list[str]) -> DataFrame:
    """Models as columns; rows that miss a model go."""
    return results.groupBy(row).pivot(model, models).agg(F.first(value)).dropna(subset=models)


def best_in_row(columns: list[str], higher: Column | bool = True) -> list[Column]:
    """Whether each column is the best of its row; ties within 1e-9 are all best."""
    up = higher if isinstance(higher, Column) else F.lit(higher)
    best = F.when(up, F.greatest(*columns)).otherwise(F.least(*columns))
    return [F.coalesce(F.abs(F.col(c) - best) < TIE, F.lit(False)).alias(f"best_{c}") for c in columns]


def wins(table: DataFrame, ours: str, rivals: list[str], higher: Column) -> DataFrame:
    """Per rival: rows ours wins and loses; ties count for neither."""
    gap = lambda r: F.when(higher, F.col(ours) - F.col(r)).otherwise(F.col(r) - F.col(ours))
    return table.select(F.explode(F.array(*[F.struct(F.lit(r).alias("rival"), gap(r).alias("gap")) for r in rivals])).alias("_s")).groupBy("_s.rival").agg(F.count_if(F.col("_s.gap") > TIE).alias("ahead"), F.count_if(F.col("_s.gap") < -TIE).alias("behind"))


def parity(a: DataFrame, b: DataFrame, keys: list[str], dist: str) -> DataFrame:
    """One row: common answers, share of equal top options, greatest probability gap."""
    both = a.select(*keys, F.col(dist).alias("_a")).join(b.select(*keys, F.col(dist).alias("_b")), keys)
    top = lambda c: F.array_position(c, F.array_max(c))
    gap = F.array_max(F.zip_with("_a", "_b", lambda x, y: F.abs(x - y)))
    return both.agg(F.count("*").alias("n"), F.avg((top("_a") == top("_b")).cast("double")).alias("argmax_agreement"), F.max(gap).alias("max_prob_gap"))


def agreement_with(base: DataFrame, other: DataFrame, keys: list[str], top: str) -> DataFrame:
    """Share of the baseline's keys on which another run has the same top option; a missing key is no match."""
    both = base.select(*keys, F.col(top).alias("_a")).join(other.select(*keys, F.col(top).alias("_b")), keys, "left")
    return both.agg(F.count("*").alias("n"), F.avg(F.coalesce(F.col("_a") == F.col("_b"), F.lit(False)).cast("double")).alias("agreement"))
