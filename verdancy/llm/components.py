"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, saved


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of edges(u, v); label is the smallest node of its component.

    Each round is a partial minimum by node and a join; adaptive execution splits
    the join's partition of a node of very high degree.  Rounds are cut by tables
    in the shared folder, of which only the result stays.
    """
    both = lambda e: e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    down = lambda e: e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    with Scratch(edges.sparkSession) as scratch:
        now = scratch.saved(down(edges), "edges")
        state = _state(now)
        while state[0]:
            near = both(now)
            least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
            large = near.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            large = scratch.saved(large.where("u <> v").distinct(), "large")
            least = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
            now = scratch.saved(down(small), "small")
            before, state = state, _state(now)
            if state == before:
                break
        least = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label"))
        return saved(least.union(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()), "components")
