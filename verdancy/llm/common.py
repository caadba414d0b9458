"""Session helpers shared by the operators: shared folder, scratch tables, column rules."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; in local mode one of our own where it is unset.

    That setting cannot be changed in a running session, so our own folder is kept as the context's checkpoint folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="verdancy-"))
        path = spark.sparkContext.getCheckpointDir()
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/verdancy/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: later jobs neither recompute it nor depend on an executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Tables of one computation, removed at its end; what outlives it is written by saved() itself."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def saved(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *failure) -> None:
        for path in self.paths:
            drop_path(self.spark, path)


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """df less the columns that a result is about to add: on a name clash the result's column wins."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def remainder(column: str, modulus: int):
    """crc32 of the id written as decimal text, modulo modulus."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


def widened(df: DataFrame, fields: Iterable[tuple[str, str]]) -> ST.StructType:
    """The schema of df with (name, type) fields after it."""
    schema = ST.StructType(list(df.schema.fields))
    for name, kind in fields:
        schema.add(name, ST.DataType.fromDDL(kind))
    return schema
