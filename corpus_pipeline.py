"""Corpus preparation: quality, near-duplicates, secrets, mixture, packing, each stage on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import mixing, ngram_join, packing, quality, secrets
from tessera.llm.common import documents, stored


#: Parts whose ids a tokenizing worker remembers: fewer than alone, as other stages share its memory.
KEPT = 200_000


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at its threshold or above.

    Each row is judged by its own text, repeated rows and ids alike; null and empty texts have the score of no evidence. The
    model is fitted on docs and the labels of sf_dir. No rows give none.
    """
    rows = docs.select(F.struct(*docs.columns).alias("_row"))
    got = quality.scored(rows, quality.quality_model(spark, docs, sf_dir), text="_row.text")
    return got.where(F.col("score") >= quality.THRESHOLD).select("_row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each class of near-duplicates.

    A class of rows without ids keeps one of them; of rows that agree in id and text one stays. Texts without words, null
    and empty ones among them, are one class. No rows give none.
    """
    return ngram_join.deduplicated(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in them replaced by their kind.

    Rows are changed one by one, so repeated ones stay; null and empty texts stay as they are. No rows give none.
    """
    return secrets.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order and as often as the mix has them.

    A null source is a source of its own; repeated rows are queued one by one; documents without words, null and empty texts
    among them, stay once. No rows give none.
    """
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents with their sequences and offsets.

    Every row is cut by itself, also where its id repeats or is null; a null or empty text is one piece, the end sign alone;
    a very long one has as many pieces as it needs. No rows give none.
    """
    return packing.pack_documents(docs, kept=KEPT)


STAGES = [("quality", keep_good), ("near_duplicates", keep_one_of_each), ("secrets", redact), ("mixing", mix), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
