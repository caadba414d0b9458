"""Record files: schema, JSON-lines scan and sink, stage tables, drops, manifests, reply caches."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

_TEXT = ("id", "lang", "source", "license", "split", "state", "questions", "targets", "reasoning", "teachers")
RECORD = ST.StructType([*[ST.StructField(c, ST.StringType()) for c in _TEXT], ST.StructField("tags", ST.ArrayType(ST.StringType())), ST.StructField("abstain", ST.BooleanType())])
MANDATORY = ("id", "lang", "source", "license", "split", "tags", "state", "questions", "targets")
LANGS = ("en", "tr", "de")
SPLITS = ("train", "calibration", "validation", "test")
OPTIONAL_EMPTY = ("", "{}", "null")


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return bool(found)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value) of text files, also compressed ones: line counts from 0 in each file, however the files are split and packed.

    A split knows where in its file it begins, so its lines are numbered by themselves and the lines of the splits before it are added.
    """
    meta = F.col("_metadata")
    lines = spark.read.text(path).select(meta["file_path"].alias("file"), meta["file_block_start"].alias("_block"), F.monotonically_increasing_id().alias("_id"), "value")
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "_block").agg(F.count("*").alias("_n")).select("file", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("file", "_block").orderBy("_id")) - 1  # a split is read by one task, so its ids rise
    return lines.withColumn("_at", inside).join(blocks, ["file", "_block"]).select("file", (F.col("_before") + F.col("_at")).alias("line"), "value")


def write_ordered(df: DataFrame, order: list[Column], text: str, path: str) -> None:
    """A text column as files whose names follow the order: ranges, each sorted and written by one task."""
    keys = {f"_o{i}": o for i, o in enumerate(order)}
    rows = df.select(F.col(text).alias("value"), *[o.alias(c) for c, o in keys.items()])
    rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("value").write.text(path)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """(place, value) of the lines of a folder, from 0, file after file by name: what write_ordered wrote, in its order."""
    lines = numbered_lines(spark, path)
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    files = lines.groupBy("file").agg(F.count("*").alias("_n")).select("file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return lines.join(files, "file").select((F.col("_before") + F.col("line")).alias("place"), "value")


def read_numbered(spark: SparkSession, path: str, schema: ST.StructType | str) -> DataFrame:
    """JSON lines with file and line; blank lines are skipped and keep their number."""
    lines = numbered_lines(spark, path).where(F.trim("value") != "")
    return lines.select("file", "line", F.from_json("value", schema).alias("r")).select("file", "line", "r.*")


def read_lines(spark: SparkSession, path: str, schema: ST.StructType = RECORD) -> DataFrame:
    """JSON lines, also gzipped; a missing file is empty and blank lines are skipped.

    Nested objects (state, questions, targets, teachers) stay JSON text, in the
    order they were written in.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.from_json("value", schema).alias("r")).select("r.*")


def write_lines(df: DataFrame, path: str) -> int:
    """JSON lines through the commit protocol; gives the row count."""
    from pyspark.sql import Observation

    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(path)
    return seen.get["n"]


def write_stage(df: DataFrame, root: str, run: str, stage: str) -> None:
    """A stage's table, partitioned by run and language."""
    df.withColumns({"run": F.lit(run), "stage": F.lit(stage)}).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "lang", "stage").parquet(root)


def read_stage(spark: SparkSession, root: str, run: str, stage: str) -> DataFrame:
    return spark.read.parquet(root).where((F.col("run") == run) & (F.col("stage") == stage)).drop("run", "stage")


def split_kept(df: DataFrame, reason: str, stage: str, row_id: str = "id") -> tuple[DataFrame, DataFrame]:
    """(kept rows, drop log) of one plan with a reason column."""
    kept = df.where(F.col(reason).isNull()).drop(reason)
    return kept, df.where(F.col(reason).isNotNull()).select(F.lit(stage).alias("stage"), F.col(row_id).alias("id"), F.col(reason).alias("reason"))


def stripped(df: DataFrame) -> DataFrame:
    """Record columns only; empty optional ones become null."""
    optional = [f.name for f in RECORD if f.name not in MANDATORY and isinstance(f.dataType, ST.StringType)]
    have = [f.name for f in RECORD if f.name in df.columns]
    return df.select(*[F.when(F.trim(c).isin(*OPTIONAL_EMPTY), None).otherwise(F.col(c)).alias(c) if c in optional else F.col(c) for c in have])


def schema_problem(df: DataFrame) -> Column:
    """The first schema problem of a record, or null."""
    missing = F.coalesce(*[F.when(F.col(c).isNull(), f"missing {c}") for c in MANDATORY])
    return F.coalesce(missing, F.when(~F.col("lang").isin(*LANGS), "bad lang"), F.when(~F.col("split").isin(*SPLITS), "bad split"), F.when(F.exists("tags", lambda t: t.isNull()), "bad tags"))


def first_ids(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Union of record files in which the first file with an id wins."""
    from ..operators.dedup import first_by

    rows = None
    for k, path in enumerate(paths):
        if not exists(spark, path):
            continue
        part = read_numbered(spark, path, RECORD).withColumn("_file", F.struct(F.lit(k), "file")).withColumnRenamed("line", "_line").drop("file")
        rows = part if rows is None else rows.unionByName(part)
    return spark.createDataFrame([], RECORD) if rows is None else first_by(rows, ["id"], ["_file", "_line"]).drop("_file", "_line")


def union_in_order(parts: list[DataFrame]) -> DataFrame:
    """Stage tables one after the other, with ord = the place of the table."""
    out = None
    for k, part in enumerate(parts):
        part = part.withColumn("ord", F.lit(k))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def digest(df: DataFrame, *columns: str) -> DataFrame:
    """One row: rows and an order-free digest of their SHA-256s."""
    row = F.sha2(F.to_json(F.struct(*columns)), 256)
    half = F.conv(F.substring(row, 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n"), F.sum(half).alias("digest"))


def _hashed(ends: str):
    """The lines of a stream as (n, digest): state and one batch are all that is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha, n = hashlib.sha256(), 0
        for batch in batches:
            if batch.num_rows:
                text = ends.join(batch.column(0).to_pylist())
                sha.update(((ends if n else "") + text).encode())
                n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([sha.hexdigest()])], names=["n", "digest"])

    return run


def manifest(df: DataFrame, *columns: str) -> DataFrame:
    """One row: rows, and the SHA-256 of the table's JSON lines in sorted order, as of the file itself.

    The lines are sorted in ranges and hashed as one stream over the ranges in order, a batch at a time: such a digest
    goes over its bytes one after the other, so this is for files that ship as one (test splits).  digest() has no order
    and is summed up anywhere.
    """
    lines = df.select(F.to_json(F.struct(*columns)).alias("l"))
    return lines.orderBy("l").coalesce(1).mapInArrow(_hashed("\n"), "n long, digest string")


def append_log(df: DataFrame, path: str, text: str) -> None:
    """Adds lines to a log, secrets in the text column redacted."""
    from ..functions.text import redacted

    df.withColumn(text, redacted(F.col(text))).write.mode("append").json(path)


def with_replies(requests: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(answered from the cache, still to ask) by the content hash of provider and body."""
    keyed = requests.withColumn("cache_key", F.sha2(F.to_json(F.array("provider", "body", F.col("attempt").cast("string"))), 256))
    known = cache.select("cache_key", "reply").dropDuplicates(["cache_key"])
    return keyed.join(known, "cache_key"), keyed.join(known, "cache_key", "left_anti")


def with_traces(rows: DataFrame, traces: DataFrame) -> DataFrame:
    """Rows with the reasoning of their trace and a reasoner tag."""
    found = traces.select(F.col("id"), F.col("trace").alias("_t"), F.col("model").alias("_m"))
    joined = rows.join(found, "id", "left")
    tags = F.when(F.col("_m").isNotNull(), F.array_append("tags", F.concat(F.lit("reasoner:"), "_m"))).otherwise(F.col("tags"))
    return joined.withColumns({"reasoning": F.coalesce("_t", "reasoning"), "tags": tags}).drop("_t", "_m")


def calibration(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(temperatures, thresholds) as key, value tables from a JSON file; both are empty without one: an uncalibrated engine."""
    kinds = "temperatures map<string,double>, auto_threshold map<string,double>"
    if not path or not exists(spark, path):
        empty = spark.createDataFrame([], "key string, value double")
        return empty, empty
    rows = spark.read.schema(kinds).option("multiLine", True).json(path)
    return rows.select(F.explode("temperatures").alias("key", "value")), rows.select(F.explode("auto_threshold").alias("key", "value"))


def stage_path(root: str, run: str, lang: str, stage: str) -> str:
    """Where write_stage puts a stage's rows of one run and language."""
    return f"{root}/run={run}/lang={lang}/stage={stage}"
