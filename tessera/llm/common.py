"""What the operators of this package share: skew-safe joins, numbered rows, bounded batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.shared import discard, new_path, release, shared_folder, stored

__all__ = ["discard", "documents", "new_path", "release", "shared_folder", "skew_join", "small_batches", "stored", "text_or_empty", "whole_row", "with_rows"]

#: Keys that a skew-safe join sends by broadcast, whatever the size of its tables.
HOT_KEYS = 1000
#: Rows and bytes of an Arrow batch; a longer text is a batch of its own.
BATCH, BATCH_BYTES = 1000, 32 << 20


def small_batches(spark: SparkSession) -> None:
    """Python workers get few rows and bytes at a time, as texts may be very long. Smaller limits of the session stay."""
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for name, most in (("maxRecordsPerBatch", BATCH), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        if not 0 < as_bytes(spark.conf.get(key)) <= most:
            spark.conf.set(key, most)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def skew_join(left: DataFrame, right: DataFrame, key: str, weight: str) -> DataFrame:
    """left with the columns of right, which has one row for each key that isn't null (left outer join).

    The HOT_KEYS heaviest keys by right's column weight are broadcast, a fixed number of rows. The join with the others has
    a second key, 0 in right. Rows of left that need it no more, served already or without a key, have another number there,
    from all of their columns: they match nothing, and no task gets all rows of a hot key.
    Right is read twice; give a stored table.
    """
    values = [c for c in right.columns if c != key]
    hot = right.where(F.col(key).isNotNull()).orderBy(F.col(weight).desc(), key).limit(HOT_KEYS)
    hot = hot.select(F.col(key).alias("_hot_key"), F.struct(*values).alias("_hot"))
    # Not a literal 0, which the optimizer would take out of the join's keys.
    cold = right.select(F.col(key).alias("_cold_key"), F.pmod(F.xxhash64(key), F.lit(1)).alias("_cold_spread"), F.struct(*values).alias("_cold"))
    spread = F.xxhash64(*[c for c, t in left.dtypes if not t.startswith("map")]).bitwiseOR(F.lit(1))
    got = left.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    got = got.withColumn("_spread", F.when(F.col("_hot_key").isNotNull() | F.col(key).isNull(), spread).otherwise(F.lit(0)))
    got = got.join(cold, (F.col(key) == F.col("_cold_key")) & (F.col("_spread") == F.col("_cold_spread")), "left").withColumn("_got", F.coalesce("_hot", "_cold"))
    return got.select(*left.columns, *[F.col("_got")[c].alias(c) for c in values])


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def whole_row(docs: DataFrame) -> DataFrame:
    """_row: each row of docs as one column, so that no column of a caller's meets one of ours; doc_id and text beside it."""
    return docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))


def with_rows(docs: DataFrame) -> DataFrame:
    """doc_id, row (a number of its own for each row), text. The id serves where ids are unique; otherwise rows are numbered in a stored copy."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    if docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        return docs.select("doc_id", F.col("doc_id").alias("row"), "text")
    return stored(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")
