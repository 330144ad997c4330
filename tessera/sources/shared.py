"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Bytes for each core up to which a table is dealt out anew before costly work on its rows; larger ones have files and row groups enough.
SMALL = 16 << 20

_stored: list[str] = []


def spread(df: DataFrame) -> DataFrame:
    """df over all cores if it is small, as a small file is one row group and so one task; else df as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size <= SMALL * cores else df


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; in local mode a new one, where none is set."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/tessera-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written to a table in the shared folder and read again: it is computed once, and a lost executor loses none of it."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    _stored.append(path)
    got = df.sparkSession.read.schema(df.schema).parquet(path)
    got._stored_at = path
    return got


@contextmanager
def shuffle_files_dropped(spark: SparkSession) -> Iterator[None]:
    """What runs meanwhile deletes its shuffle files as soon as it ends; else they stay until the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def remove(spark: SparkSession, *paths: str) -> None:
    """Deletes files or folders that are not read any more."""
    for path in paths:
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Deletes what stored() has written; nothing that is still to be computed may read it."""
    for table in tables:
        _stored.remove(table._stored_at)
        _delete(table.sparkSession, table._stored_at)


def release(spark: SparkSession) -> None:
    """Deletes the tables that this session has stored; results that read them must have been written."""
    while _stored:
        _delete(spark, _stored.pop())
