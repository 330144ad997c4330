"""Labels, hard negatives, splits and samples. Splits and samples follow hashes of ids, so they agree between runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.order import first_rows
from tessera.sources.shared import stored

#: Of each source in the benchmark's pool.
DISTRACTORS = 250_000


def truth_pairs(truth: DataFrame) -> DataFrame:
    return truth.select("source1_entity_id", F.explode("matched").alias("candidate_entity_id")).distinct()


def with_lists(of: DataFrame, lists: DataFrame) -> DataFrame:
    """Truth (source1_entity_id, matched) of queries (source1_entity_id, _set; each id once) that share lists (_set, matched); both stored.

    labelled() and beside() take queries and lists apart, so that a list is not moved once for each of its queries.
    """
    got = of.join(lists, "_set", "left").select("source1_entity_id", F.coalesce("matched", F.array().cast("array<string>")).alias("matched"))
    got._lists = of, lists
    return got


def beside(truth: DataFrame, other: DataFrame) -> DataFrame:
    """truth with the columns of other (source1_entity_id, ...), null where other lacks a query."""
    if not hasattr(truth, "_lists"):
        return truth.join(other, "source1_entity_id", "left")
    of, lists = truth._lists
    got = of.join(other, "source1_entity_id", "left").join(lists, "_set", "left")
    return got.select("source1_entity_id", F.coalesce("matched", F.array().cast("array<string>")).alias("matched"), *[c for c in other.columns if c != "source1_entity_id"])


def truth_where(truth: DataFrame, condition: Column) -> DataFrame:
    """The truth of the queries for which a condition on source1_entity_id holds."""
    if not hasattr(truth, "_lists"):
        return truth.where(condition)
    of, lists = truth._lists
    return with_lists(of.where(condition), lists)


def kinds(members: DataFrame, truth: DataFrame, share: float) -> tuple[DataFrame, DataFrame]:
    """Queries that agree in text (members: entity_id, _as), list of truth and fitted (whether in_share() has them) are one kind, named by its least id.

    entity_id, source1_entity_id (its kind), stored; and source1_entity_id, _as, fitted, weight (how many). Without shared lists each query is a kind.
    """
    rows = members.withColumn("fitted", in_share("entity_id", share))
    if not hasattr(truth, "_lists"):
        rows = stored(rows.withColumn("source1_entity_id", F.col("entity_id")), "kinds")
        return rows.select("entity_id", "source1_entity_id"), rows.select("source1_entity_id", "_as", "fitted", F.lit(1.0).alias("weight"))
    of, _ = truth._lists
    rows = rows.join(of.select(F.col("source1_entity_id").alias("entity_id"), "_set"), "entity_id", "left").withColumn("_set", F.coalesce("_set", F.lit(-1)))
    key = ["_as", "_set", "fitted"]
    rows = stored(rows, "parts")
    found = stored(rows.groupBy(*key).agg(F.min("entity_id").alias("source1_entity_id"), F.count("*").cast("double").alias("weight")), "kinds")
    return rows.join(found, key).select("entity_id", "source1_entity_id"), found.drop("_set")


def labelled(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """pairs with label, 1 for true pairs. The lists of truth stay lists: all true pairs may be many more than pairs."""
    if hasattr(truth, "_lists"):
        of, lists = truth._lists
        held = lists.select("_set", F.explode("matched").alias("candidate_entity_id")).distinct().withColumn("_true", F.lit(1))
        got = pairs.join(of, "source1_entity_id", "left").join(held, ["_set", "candidate_entity_id"], "left")
        return got.select(*pairs.columns, F.coalesce("_true", F.lit(0)).alias("label"))
    true = truth.select(F.col("source1_entity_id").alias("_query"), F.col("matched").alias("_matched"))
    same = (F.col("source1_entity_id") == F.col("_query")) & F.array_contains("_matched", F.col("candidate_entity_id"))
    kinds = [pairs.join(true, same, how).withColumn("label", F.lit(label)) for how, label in (("left_semi", 1), ("left_anti", 0))]
    return kinds[0].unionByName(kinds[1])


def with_true_pairs(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Candidate pairs and all true pairs, each once."""
    return pairs.select("source1_entity_id", "candidate_entity_id").union(truth_pairs(truth)).distinct()


def hard_negatives(pairs: DataFrame, n: int = 5) -> DataFrame:
    """All positives, and of each query the n negatives of lowest blocking_rank."""
    order = Window.partitionBy("source1_entity_id", "label").orderBy("blocking_rank", "candidate_entity_id")
    return pairs.withColumn("_n", F.row_number().over(order)).where((F.col("label") == 1) | (F.col("_n") <= n)).drop("_n")


def class_balance(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("label").agg(F.count("*").alias("pairs"))


def hash_digits(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key)).cast("binary"))


def in_share(key: str, share: float, seed: int = 42) -> Column:
    """Whether the hash of a key falls in that share of all hashes."""
    return F.substring(hash_digits(key, seed), 1, 8) < f"{int(share * 16**8):08x}" if share < 1 else F.lit(True)


def split(entities: DataFrame, share: float = 0.8, key: str = "entity_id", seed: int = 42) -> tuple[DataFrame, DataFrame]:
    return entities.where(in_share(key, share, seed)), entities.where(~in_share(key, share, seed))


def sample(entities: DataFrame, n: int, key: str = "entity_id", seed: int = 42) -> DataFrame:
    """n rows, those of the least hashes."""
    return entities.orderBy(hash_digits(key, seed), key).limit(n)


def benchmark_pool(pool: DataFrame, truth: DataFrame, distractors: int = DISTRACTORS, seed: int = 42) -> DataFrame:
    """All true partners, and of each source as many of its other rows, those of the least hashes."""
    partners = truth_pairs(truth).select(F.col("candidate_entity_id").alias("entity_id")).distinct()
    others = pool.join(partners, "entity_id", "left_anti").withColumns({"_source": F.substring("entity_id", 1, 3), "_hash": hash_digits("entity_id", seed)})
    others = first_rows(others, ["_source"], F.left("_hash", F.lit(4)), [F.col("_hash"), F.col("entity_id")], distractors)
    return pool.join(partners, "entity_id", "left_semi").unionByName(others.drop("_source", "_hash"))
