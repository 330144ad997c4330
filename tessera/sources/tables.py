"""Reading entity tables, ground truth and id lists, and test tables seen as entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.sources.shared import spread, stored

ENTITY = "entity_id string, business_name string, business_address string, country string"
#: Texts that the option missing_words of read_entities reads as null.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def read_entities(spark: SparkSession, path: str | list[str], countries: list[str] | None = None, missing_words: bool = False) -> DataFrame:
    """Tab-separated entities of one or more files, all columns text; only of some countries if given. An empty value is null."""
    got = spark.read.csv(path, sep="\t", header=True, schema=ENTITY, quote='"', escape='"')
    if missing_words:
        got = got.select(*[F.when(~F.col(c).isin(*MISSING), F.col(c)).alias(c) for c in got.columns])
    return got.where(F.col("country").isin(*countries)) if countries is not None else got


def read_split(spark: SparkSession, folder: str, countries: list[str] | None = None, missing_words: bool = False) -> dict[str, DataFrame]:
    """source1, source2, source3 and, in a training folder, ground_truth. The files begin with test if the folder's name holds that word, else with train."""
    prefix = "test" if "test" in folder.rstrip("/").rpartition("/")[2] else "train"
    out = {f"source{i}": read_entities(spark, f"{folder}/{prefix}_source{i}.tsv", countries, missing_words) for i in (1, 2, 3)}
    return out | ({"ground_truth": read_truth(spark, f"{folder}/{prefix}_ground_truth.tsv")} if prefix == "train" else {})


def stage_by_country(entities: DataFrame, path: str) -> DataFrame:
    """entities as Parquet with a folder for each country, so that reading some countries reads no others."""
    entities.write.partitionBy("country").mode("overwrite").parquet(path)
    return entities.sparkSession.read.schema(entities.schema).parquet(path)


def available_countries(entities: DataFrame) -> DataFrame:
    return entities.where("country <> ''").select("country").distinct().orderBy("country")


def split_ids(ids: str, trim: bool = True) -> F.Column:
    """The ids of a comma list, each once; none for null, empty or nan."""
    cut = F.split(F.coalesce(F.col(ids), F.lit("")), ",")
    cut = F.filter(F.transform(cut, lambda x: F.trim(x)) if trim else cut, lambda x: x != "")
    return F.when(F.lower(F.trim(F.coalesce(F.col(ids), F.lit("")))).isin("", "nan"), F.array().cast("array<string>")).otherwise(F.array_distinct(cut))


def read_truth(spark: SparkSession, path: str, trim: bool = True) -> DataFrame:
    """source1_entity_id, matched: an array of ids, empty for a singleton."""
    got = spark.read.csv(path, sep="\t", header=True, schema="source1_entity_id string, matched_entity_ids string", quote='"', escape='"')
    return got.select(F.trim("source1_entity_id").alias("source1_entity_id"), split_ids("matched_entity_ids", trim).alias("matched"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """entity_id: the first columns of a raw table, without its first line and blank lines."""
    lines = spark.read.csv(path, sep="\t", header=True, schema="entity_id string", quote="", comment="", enforceSchema=True)
    return lines.select(F.trim("entity_id").alias("entity_id")).where("entity_id <> ''").distinct()


def match_targets(source2: DataFrame | None, source3: DataFrame | None) -> DataFrame | None:
    """The ids that may be matched; None where a table is missing."""
    if source2 is None or source3 is None:
        return None
    return source2.select("entity_id").union(source3.select("entity_id")).distinct()


def only_ids(entities: DataFrame, ids: DataFrame) -> DataFrame:
    return entities.join(ids.select("entity_id"), "entity_id", "left_semi")


def head(entities: DataFrame, n: int) -> DataFrame:
    """The first n by id; rows of a table have no order of their own."""
    return entities.orderBy("entity_id").limit(n)


def best_threshold(search: DataFrame, otherwise: float = 0.88) -> float:
    """The lowest threshold of the greatest macro_f05."""
    row = search.orderBy(F.desc("macro_f05"), "threshold").first()
    return float(row["threshold"]) if row else otherwise


def read_search(spark: SparkSession, path: str) -> DataFrame:
    """threshold, macro_f05 of a search file."""
    return spark.read.csv(path, sep="\t", header=True, schema="threshold double, macro_f05 double")


def read_features(spark: SparkSession, path: str, names: tuple[str, ...]) -> DataFrame:
    """A table of pair features. Missing columns are an error."""
    got = spark.read.parquet(path)
    lacking = [n for n in names if n not in got.columns]
    if lacking:
        raise ValueError(f"features are missing: {', '.join(lacking)}")
    return got


def pool(source2: DataFrame, source3: DataFrame) -> DataFrame:
    return source2.unionByName(source3)


def first_of_each(entities: DataFrame) -> DataFrame:
    """One row for each entity_id, the least by its other columns."""
    order = Window.partitionBy("entity_id").orderBy(*[c for c in entities.columns if c != "entity_id"])
    return entities.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def one_of_each_text(entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """entities without rows that agree in all but the id with one of a lesser id; and entity_id, _as: each id and the one that stands for it.

    Ids on several rows stand for themselves, with all of their rows.
    """
    columns = [c for c in entities.columns if c != "entity_id"]
    more = stored(entities.groupBy("entity_id").count().where("count > 1").select("entity_id"), "repeated")
    once = entities.join(more, "entity_id", "left_anti")
    first = once.groupBy(*columns).agg(F.min("entity_id").alias("_as"))
    kept = first.select(F.col("_as").alias("entity_id"), *columns).select(*entities.columns).unionByName(entities.join(more, "entity_id", "left_semi").select(*entities.columns))
    one, two = once.alias("one"), first.alias("two")
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"one.{c}").eqNullSafe(F.col(f"two.{c}"))
    members = one.join(two, same).select("one.entity_id", "two._as")
    return stored(kept, "texts"), members.unionByName(more.withColumn("_as", F.col("entity_id")))


def _sources(entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Queries (S1) and pool (S2 and S3)."""
    one = F.col("entity_id").startswith("S1-")
    return entities.where(one), entities.where(~one)


def document_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as entities: the name is the first line of a text, the address all the rest, the country its language."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source"))
    line = F.substring_index("text", "\n", 1)
    kind = F.concat(F.lit("S"), (F.substring("source", 4, 9).cast("int") % 3 + 1).cast("string"), F.lit("-"))
    return docs.select(F.concat(kind, F.col("doc_id").cast("string")).alias("entity_id"), line.alias("business_name"), F.substr("text", F.length(line) + 2).alias("business_address"), F.col("lang").alias("country"))


def part_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as entities: brand and size are the address, the type is the country."""
    parts = spread(spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_name", "p_brand", "p_size", "p_type"))
    kind = F.concat(F.lit("S"), (F.col("p_partkey") % 3 + 1).cast("string"), F.lit("-"))
    address = F.concat_ws(" ", "p_brand", F.col("p_size").cast("string"))
    return parts.select(F.concat(kind, F.col("p_partkey").cast("string")).alias("entity_id"), F.col("p_name").alias("business_name"), address.alias("business_address"), F.col("p_type").alias("country"))


def document_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return _sources(document_entities(spark, sf_dir))


def part_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return _sources(part_entities(spark, sf_dir))
