"""Evaluation: macro F0.5 with singletons, threshold search, audit figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The threshold grids, as hundredths.
SEARCH_GRID, DISCOUNT_GRID = tuple(range(50, 97)), tuple(range(70, 94, 2))


def none() -> Column:
    return F.array().cast("array<string>")


def f05(hits: Column, predicted: Column, true: Column) -> Column:
    """F0.5 of counts: 1 if nothing is true and nothing predicted, 0 without a hit."""
    return F.when((predicted == 0) & (true == 0), 1.0).when(hits == 0, 0.0).otherwise(1.25 * hits / (0.25 * true + predicted))


def predictions(claims: DataFrame, threshold: float) -> DataFrame:
    """source1_entity_id, predicted: of each query in claims the candidates at threshold or above, empty if there are none."""
    return claims.groupBy("source1_entity_id").agg(F.array_sort(F.collect_set(F.when(F.col("probability") >= threshold, F.col("candidate_entity_id")))).alias("predicted"))


def macro_f05(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """macro_f05 over the queries of truth; a query without a prediction counts as predicted empty, 0 for an empty truth."""
    from tessera.operators.labels import beside

    got = beside(truth, predicted).withColumn("predicted", F.coalesce("predicted", none()))
    each = f05(F.size(F.array_intersect("matched", "predicted")), F.size("predicted"), F.size("matched"))
    return got.agg(F.round(F.coalesce(F.avg(each), F.lit(0.0)), 6).alias("macro_f05"))


def threshold_search(claims: DataFrame, truth: DataFrame, grid: tuple[int, ...] = SEARCH_GRID, assign: bool = False) -> DataFrame:
    """threshold, macro_f05 (4 decimals) for each threshold of the grid, in hundredths.

    Each claim is brought down to the last threshold it passes, and counts are summed over thresholds from above, so claims
    are read once whatever the grid. assign: only the best claim of each candidate counts, which no threshold changes.
    """
    from tessera.operators.assign import assign_pool_unique
    from tessera.operators.labels import labelled

    claims = assign_pool_unique(claims) if assign else claims
    spark = claims.sparkSession
    steps = spark.createDataFrame([(g,) for g in grid], "step int")
    true = labelled(claims.where(F.col("probability") >= grid[0] / 100), truth)
    passed = F.array_max(F.filter(F.array(*[F.lit(g) for g in grid]), lambda g: F.col("probability") >= g / 100))
    counts = true.withColumn("step", passed).groupBy("source1_entity_id", "step").agg(F.count("*").alias("_p"), F.sum("label").alias("_h"))
    above = Window.partitionBy("source1_entity_id").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = Window.partitionBy("source1_entity_id").orderBy("step")
    counts = counts.withColumns({"_p": F.sum("_p").over(above), "_h": F.sum("_h").over(above), "_from": F.lag("step").over(last)})
    sizes = truth.select("source1_entity_id", F.size("matched").alias("_t"))
    base = sizes.agg(F.count("*").alias("n"), F.count_if(F.col("_t") == 0).alias("n0"))
    # A query's own value differs from that of an empty prediction only at steps where it predicts something.
    own = counts.join(sizes, "source1_entity_id").withColumn("gain", f05(F.col("_h"), F.col("_p"), F.col("_t")) - F.when(F.col("_t") == 0, 1.0).otherwise(0.0))
    gains = own.join(F.broadcast(steps).withColumnRenamed("step", "at"), (F.col("at") <= F.col("step")) & (F.col("_from").isNull() | (F.col("at") > F.col("_from"))))
    gains = gains.groupBy("at").agg(F.sum("gain").alias("gain"))
    got = steps.withColumnRenamed("step", "at").join(gains, "at", "left").crossJoin(F.broadcast(base))  # base is one row
    value = F.when(F.col("n") > 0, (F.col("n0") + F.coalesce("gain", F.lit(0.0))) / F.col("n")).otherwise(0.0)
    return got.select((F.col("at") / 100).alias("threshold"), F.round(value, 4).alias("macro_f05"))


def audit_summary(truth: DataFrame, candidates: DataFrame, predicted: DataFrame) -> DataFrame:
    """One row of percentages: of true pairs that are candidates, of those that are predicted, micro and macro precision and recall, singletons left alone (100 if there are none), and macro_f05.

    Macro precision is over queries with both truths and predictions, macro recall over queries with truths.
    """
    own = candidates.groupBy("source1_entity_id").agg(F.collect_set("candidate_entity_id").alias("_c"))
    got = truth.join(own, "source1_entity_id", "left").join(predicted, "source1_entity_id", "left")
    got = got.withColumns({"_c": F.coalesce("_c", none()), "_p": F.coalesce("predicted", none())})
    got = got.select(F.size("matched").alias("t"), F.size("_p").alias("p"), F.size(F.array_intersect("matched", "_c")).alias("in_c"), F.size(F.array_intersect("matched", "_p")).alias("hit"))
    share = lambda a, b, none=0.0: F.round(F.when(b > 0, 100.0 * a / b).otherwise(none), 6)
    mean = lambda c: F.round(F.coalesce(100.0 * F.avg(c), F.lit(0.0)), 6)
    t, p, c, h = (F.sum(x) for x in ("t", "p", "in_c", "hit"))
    single = F.col("t") == 0
    return got.agg(
        share(c, t).alias("blocking_recall"), share(h, c).alias("classifier_retention"), share(h, p).alias("micro_precision"), share(h, t).alias("micro_recall"),
        mean(F.when(~single & (F.col("p") > 0), F.col("hit") / F.col("p"))).alias("macro_precision"), mean(F.when(~single, F.col("hit") / F.col("t"))).alias("macro_recall"),
        share(F.count_if(single & (F.col("p") == 0)), F.count_if(single), 100.0).alias("singleton_accuracy"),
        F.round(F.coalesce(F.avg(f05(F.col("hit"), F.col("p"), F.col("t"))), F.lit(0.0)), 6).alias("macro_f05"),
    )


def output_counts(collected: DataFrame) -> DataFrame:
    """rows, empty and non_empty lists, ids of an output with the array column ids."""
    return collected.agg(F.count("*").alias("n_rows"), F.count_if(F.size("ids") == 0).alias("n_empty"), F.count_if(F.size("ids") > 0).alias("n_filled"), F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("n_ids"))
