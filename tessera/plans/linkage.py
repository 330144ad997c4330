"""Whole runs: the four modes as settings of one plan."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import features
from tessera.operators import assign, blocking, labels, metrics, model
from tessera.sources import tables
from tessera.sources.shared import stored

#: Fixed value: mode B's threshold where nothing can be searched.
NO_PAIRS = 0.85
#: Modes whose entity files write missing values as words.
MISSING_WORDS = ("A", "D")


@dataclass(frozen=True)
class LinkConfig:
    """mode: A (rare-token index), B (TF-IDF), C (best cosine only) or D (character n-grams)."""

    mode: str = "A"
    k: int = blocking.K
    token_cap: int = blocking.TOKEN_CAP
    df_cap: int = blocking.DF_CAP
    min_df: int = blocking.MIN_DF
    vocabulary: int = blocking.VOCABULARY
    threshold: float = 0.88
    discount: bool = False
    pool_unique: bool = True
    negatives: int = 5
    trees: int | None = None
    rate: float | None = None


MODES = {
    "A": LinkConfig(),
    "B": LinkConfig("B", k=blocking.TFIDF_K, discount=True),
    "C": LinkConfig("C", k=1, min_df=2, threshold=0.76, pool_unique=False),
    "D": LinkConfig("D", pool_unique=False),
}


def configured(mode: str, **changes: object) -> LinkConfig:
    return replace(MODES[mode], **changes)


def candidates(config: LinkConfig, queries: DataFrame, pool: DataFrame) -> DataFrame:
    if config.mode == "A":
        return blocking.block_topk(queries, pool, config.k, config.token_cap, config.df_cap)
    if config.mode == "D":
        return blocking.charwb_knn(queries, pool, config.k)
    return blocking.tfidf_topk(queries, pool, config.k, config.min_df, config.vocabulary)


def pair_features(config: LinkConfig, pairs: DataFrame, queries: DataFrame, pool: DataFrame) -> DataFrame:
    """Mode B leaves out candidates without a row in the pool; the others take their text as empty. Of several rows of an id the least counts."""
    build = {"A": features.mode_a, "B": features.mode_b, "D": features.mode_d}[config.mode]
    return build(features.with_sides(pairs, tables.first_of_each(queries), tables.first_of_each(pool), inner=config.mode == "B"))


def compared(config: LinkConfig, queries: DataFrame, pool: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features of one query of each text (source1_entity_id) with its candidates, and entity_id, _as: each query and the one that stands for it; both stored.

    Queries of one text have the same candidates and features, so that both are made once for all of them.
    """
    few, members = tables.one_of_each_text(queries)
    pairs = stored(candidates(config, few, pool), "candidates")
    return stored(pair_features(config, pairs, few, pool), "features"), stored(members, "members")


def train(config: LinkConfig, queries: DataFrame, pool: DataFrame, truth: DataFrame, holdout: float = 0.25) -> tuple[PipelineModel, float, DataFrame]:
    """A model, its threshold, and the search; fitted on a share of the queries, searched on the others, never on the same.

    Mode B without a pair to search on has the one threshold NO_PAIRS, of value 0.
    """
    return trained(config, *compared(config, queries, pool), truth, holdout)


def trained(config: LinkConfig, known: DataFrame, members: DataFrame, truth: DataFrame, holdout: float = 0.25) -> tuple[PipelineModel, float, DataFrame]:
    """train() from compared() pairs. Queries that agree in text, list of truth and part give the same examples, which are one with their number as weight."""
    share = 1 - holdout
    rows, kinds = labels.kinds(members, truth, share)
    pairs = known.withColumnRenamed("source1_entity_id", "_as").join(kinds, "_as")
    fitted, rest = pairs.where("fitted"), pairs.where("not fitted")
    examples = stored(labels.hard_negatives(labels.labelled(fitted, truth), config.negatives), "examples")
    made = model.train(examples, config.mode, config.trees, config.rate, "weight")
    claims = scored(config, made, rest).select("source1_entity_id", "candidate_entity_id", "probability")
    if not config.pool_unique:  # else only the least of queries that claim a row alike can keep it
        claims = rows.join(claims, "source1_entity_id").select(F.col("entity_id").alias("source1_entity_id"), "candidate_entity_id", "probability")
    judged = labels.truth_where(truth, ~labels.in_share("source1_entity_id", share))
    return made, *searched(config, stored(claims, "claims"), judged)


def decided(config: LinkConfig, made: PipelineModel, known: DataFrame, members: DataFrame) -> DataFrame:
    """link()'s matches from compared() pairs."""
    claims = assign.accepted(scored(config, made, known), config.threshold)
    if config.pool_unique:  # ties go to the least id of a text, which stands for it
        return assign.assign_pool_unique(claims)
    return members.join(claims.withColumnRenamed("source1_entity_id", "_as"), "_as").withColumnRenamed("entity_id", "source1_entity_id").drop("_as")


def searched(config: LinkConfig, claims: DataFrame, truth: DataFrame) -> tuple[float, DataFrame]:
    """The best threshold and the search."""
    if config.mode == "B" and claims.isEmpty():
        return NO_PAIRS, claims.sparkSession.createDataFrame([(NO_PAIRS, 0.0)], "threshold double, macro_f05 double")
    grid = metrics.DISCOUNT_GRID if config.mode == "B" else metrics.SEARCH_GRID
    search = stored(metrics.threshold_search(claims, truth, grid, config.pool_unique), "search")
    return tables.best_threshold(search), search


def scored(config: LinkConfig, made: PipelineModel, pairs: DataFrame) -> DataFrame:
    got = model.scored(made, pairs)
    return assign.discounted(got) if config.discount else got


def link(config: LinkConfig, queries: DataFrame, pool: DataFrame, made: PipelineModel | None = None) -> tuple[DataFrame, DataFrame]:
    """Candidates, stored, and matches, long tables. Mode C needs no model."""
    if config.mode != "C" and made is None:
        raise ValueError(f"mode {config.mode} needs a model")
    pairs = stored(candidates(config, queries, pool), "candidates")
    if config.mode == "C":
        return pairs, pairs.where(pairs["score"] >= config.threshold).withColumnRenamed("score", "probability")
    claims = assign.accepted(scored(config, made, pair_features(config, pairs, queries, pool)), config.threshold)
    return pairs, assign.assign_pool_unique(claims) if config.pool_unique else claims
