"""The first rows of few, large groups, without a task that sorts a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_rows(df: DataFrame, keys: list[str], coarse: Column, order: list[Column], n: int) -> DataFrame:
    """The n first rows of each group by order, which must be total.

    coarse: a value that never falls along the order, many of them in a group. Rows are counted by it, and sorted only among
    those that agree in it and lie before the limit. df is read twice.
    """
    df = df.withColumn("_coarse", coarse)
    before = F.sum("count").over(Window.partitionBy(*keys).orderBy("_coarse").rowsBetween(Window.unboundedPreceding, -1))
    kept = df.groupBy(*keys, "_coarse").count().withColumn("_before", F.coalesce(before, F.lit(0))).where(F.col("_before") < n).drop("count")
    place = F.row_number().over(Window.partitionBy(*keys, "_coarse").orderBy(*order))
    got = df.join(kept, [*keys, "_coarse"]).withColumn("_place", F.col("_before") + place).where(F.col("_place") <= n)
    return got.drop("_coarse", "_before", "_place")
