"""Structured Streaming wrappers of the column functions (an extension; batch is the contract)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def exact_dedup_stream(rows: DataFrame, time: str, delay: str) -> DataFrame:
    """First arrival of each state key within the watermark."""
    return rows.withColumn("state_key", X.state_key(F.col("state"))).withWatermark(time, delay).dropDuplicatesWithinWatermark(["state_key"])


def usage_stream(calls: DataFrame, time: str, width: str, delay: str) -> DataFrame:
    """Calls and seconds per model and time window."""
    return calls.withWatermark(time, delay).groupBy(F.window(time, width), "model").agg(F.count("*").alias("calls"), F.sum("seconds").alias("seconds"))
