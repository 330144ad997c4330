"""Decisions: discounted probabilities, thresholds, and each pool row matched once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DISCOUNT = 0.5


def discounted(scored: DataFrame, factor: float = DISCOUNT) -> DataFrame:
    """probability times factor where house_conflict is 1."""
    return scored.withColumn("probability", F.round(F.when(F.col("house_conflict") == 1, F.col("probability") * factor).otherwise(F.col("probability")), 7))


def assign_pool_unique(claims: DataFrame) -> DataFrame:
    """The claims whose query has the greatest probability for their candidate, ties to the smaller query id.

    Queries may keep many matches, so this is what taking claims greedily by probability gives.
    """
    order = Window.partitionBy("candidate_entity_id").orderBy(F.desc("probability"), "source1_entity_id")
    return claims.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def accepted(claims: DataFrame, threshold: float) -> DataFrame:
    return claims.where(F.col("probability") >= threshold)


def best_single(scores: DataFrame, threshold: float) -> DataFrame:
    """The best candidate of each query, if it reaches the threshold; ties to the smaller candidate id."""
    order = Window.partitionBy("source1_entity_id").orderBy(F.desc("score"), "candidate_entity_id")
    return scores.withColumn("_n", F.row_number().over(order)).where((F.col("_n") == 1) & (F.col("score") >= threshold)).drop("_n")


def collected(pairs: DataFrame, queries: DataFrame, order: str | None = None, ascending: bool = True) -> DataFrame:
    """source1_entity_id, ids: for each query the array of its candidates by a column, or by id; empty for those without."""
    pairs = pairs.select("source1_entity_id", "candidate_entity_id", *([order] if order else []))
    key = F.struct((F.col(order) if ascending else -F.col(order)).alias("o"), F.col("candidate_entity_id").alias("id")) if order else F.struct(F.col("candidate_entity_id").alias("id"))
    own = pairs.groupBy("source1_entity_id").agg(F.transform(F.array_sort(F.collect_list(key)), lambda x: x["id"]).alias("ids"))
    got = queries.select(F.col("entity_id").alias("source1_entity_id")).join(own, "source1_entity_id", "left")
    return got.withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))
