"""The folder every executor can reach, and tables written there to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Known from Spark 4.1 on; an older one takes no notice of it.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
COMPACT = {"compression": "zstd", "parquet.compression.codec.zstd.level": "6"}

_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` as the cluster names it; a temporary one only in local mode."""
    global _local_folder
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="vigiltx-")
    return _local_folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/vigiltx/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, name: str):
    """The path and its file system; goes through Hadoop, so any Spark path works."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """What runs inside gives its shuffle files back as it ends, not when the driver next
    collects garbage: a job of many steps would keep those of all of them."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def write_compact(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write Parquet that takes little disk, its shuffles included."""
    with shuffles_released(df.sparkSession):
        df.write.mode(mode).options(**COMPACT).parquet(path)


@contextmanager
def lent(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` as a table written for the time being; its files go at the end."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    try:
        write_compact(df, path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder, fs = hadoop_path(spark, path)
        fs.delete(folder, True)
