"""Candidates for each query entity: by an index of rare tokens, or by cosine similarity of TF-IDF vectors.

Country stands in every join and grouping key next to the token, so pairs never cross a border and no country has to fit in
one task; a null country matches nothing. Scores are rounded before they are ordered, ties go to the smaller id.

Rows that agree in country and words score alike, so they are one class, named by its least id, and only classes are compared.
The k best rows of a query lie in its k best classes, by score and then least id, among the k least ids of each. The sums of
pairs of classes are made where a query's class stands and never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import features, text
from tessera.operators.order import first_rows
from tessera.sources.shared import stored

K, TOKEN_CAP, DF_CAP = 20, 15, 20_000
#: Of the TF-IDF modes: candidates, least document frequency, vocabulary.
TFIDF_K, MIN_DF, VOCABULARY = 12, 5, 30_000
#: Rows that a task of the join of tokens makes, about.
PAIRS = 1_000_000
#: Vectors of queries and of the pool that a task compares.
QUERY_BLOCK, POOL_BLOCK = 2_000, 20_000


def blocking_text() -> Column:
    return text.combined(text.clean_canonical("business_name"), text.clean_canonical("business_address"))


def tfidf_text(fold: bool = True) -> Column:
    return text.combined(text.clean_name("business_name", fold), text.clean_address("business_address", fold), trim=True)


def entity_tokens(entities: DataFrame, words: Column | None = None) -> DataFrame:
    """entity_id, country, token: each different token of a row once."""
    words = text.canonical_tokens("business_name", "business_address") if words is None else words
    return entities.where(F.col("country").isNotNull()).select("entity_id", "country", F.explode(F.array_distinct(words)).alias("token"))


def short(c: Column) -> Column:
    """c, or the hash of a long one, to group by."""
    return F.when(F.length(c) < 64, c).otherwise(F.sha2(c, 256))


def classes(entities: DataFrame, words: Column) -> tuple[DataFrame, DataFrame]:
    """Classes of rows that agree in country and words, stored: entity_id (the least), country, words, rows (how many), alone; and members: entity_id, class.

    words: of business_name and business_address, worked out once for each different text. An id on several rows is a class by
    itself, alone, with as many rows here as it has.
    """
    name, address = (F.coalesce(c, F.lit("")).alias(c) for c in ("business_name", "business_address"))
    rows = entities.where(F.col("country").isNotNull()).select("entity_id", "country", name, address)
    more = stored(rows.groupBy("entity_id").agg(F.count("*").alias("_n")).where("_n > 1").select("entity_id"), "repeated")
    repeated = not more.isEmpty()
    once = rows.join(more, "entity_id", "left_anti") if repeated else rows
    once = once.withColumn("_text", short(F.concat(F.length("business_name"), F.lit(":"), "business_name", "business_address")))
    same = once.groupBy("country", "_text").agg(F.min("entity_id").alias("entity_id"), F.any_value(F.struct("business_name", "business_address")).alias("_t"), F.count("*").alias("rows"))
    same = same.select("country", "_text", "entity_id", "rows", "_t.*").select("country", "_text", "entity_id", "rows", words.alias("words"))
    same = stored(same.withColumn("_key", short(F.col("words"))), "texts")
    found = stored(same.groupBy("country", "_key").agg(F.min("entity_id").alias("entity_id"), F.any_value("words").alias("words"), F.sum("rows").alias("rows")), "classes")
    class_of = same.select("country", "_text", "_key").join(found.select("country", "_key", F.col("entity_id").alias("class")), ["country", "_key"]).drop("_key")
    members = once.select("entity_id", "country", "_text").join(class_of, ["country", "_text"]).select("entity_id", "class")
    found = found.drop("_key").withColumn("alone", F.lit(False))
    if repeated:
        own = rows.join(more, "entity_id", "left_semi").select("country", "entity_id", words.alias("words"), F.lit(1).cast("long").alias("rows"), F.lit(True).alias("alone"))
        found = found.unionByName(own)
        members = members.unionByName(more.withColumn("class", F.col("entity_id")))
    return found, stored(members, "members")


def rows_of(entities: DataFrame) -> Column:
    """How many rows an entity stands for."""
    return F.col("rows") if "rows" in entities.columns else F.lit(1).cast("long")


def country_sizes(pool: DataFrame) -> DataFrame:
    return pool.where(F.col("country").isNotNull()).groupBy("country").agg(F.sum(rows_of(pool)).alias("n"))


def token_idf(pool_tokens: DataFrame, sizes: DataFrame, df_cap: int | None = DF_CAP, min_df: int = 1) -> DataFrame:
    """country, token, df, idf = ln((n + 1) / (df + 1)) + 1 of the tokens on at most df_cap and at least min_df rows."""
    df = pool_tokens.groupBy("country", "token").agg(F.sum(rows_of(pool_tokens)).alias("df")).where(F.col("df") >= min_df)
    df = df if df_cap is None else df.where(F.col("df") <= df_cap)
    return df.join(sizes, "country").select("country", "token", "df", F.round(F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1, 9).alias("idf"))


def postings(pool_tokens: DataFrame, idf: DataFrame) -> DataFrame:
    return pool_tokens.join(idf, ["country", "token"])


def ranked(scores: DataFrame, k: int, *within: str) -> DataFrame:
    """scores with blocking_rank, the k best of each query. within: columns that a query determines and that scores is partitioned by."""
    order = Window.partitionBy(*within, "source1_entity_id").orderBy(F.desc("score"), "candidate_entity_id")
    return scores.withColumn("blocking_rank", F.row_number().over(order)).where(F.col("blocking_rank") <= k)


def summed(asked: DataFrame, postings: DataFrame, token_cap: int = TOKEN_CAP) -> DataFrame:
    """_part, source1_entity_id, candidate_entity_id, score: idf, summed over the tokens that a query and a pool row have in common.

    asked: source1_entity_id, country, token, idf, at most token_cap rows of a query; postings: candidate_entity_id, country,
    token; both stored, as they are read twice. A double of 1 to 32 is an integer of 2**-52, so sums of these integers are those
    of the doubles without any rounding, whatever their order; halves of the 6th decimal go up. The rows of a query stand in one
    partition, _part; postings go to the partitions that ask for their token, which never makes more rows than pairs.
    """
    # A sum of token_cap values below 32 has to fit into 63 bits; over 64 tokens, the last bits of each are cut.
    unit = 2.0 ** min(52, 58 - (token_cap - 1).bit_length())
    key = ["country", "token"]
    load = asked.groupBy(*key).agg(F.count("*").alias("_asked")).join(postings.groupBy(*key).agg(F.count("*").alias("_df")), key)
    load = stored(load.withColumn("_rows", F.col("_asked") * F.col("_df")), "load")
    rows = load.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    tasks = max(int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // PAIRS))
    asked = asked.withColumn("_part", F.pmod(F.xxhash64("source1_entity_id"), F.lit(tasks)).cast("int"))
    # A token whose postings would make too many rows of one task is dealt out by candidate.
    pieces = F.ceil(F.least(F.col("_asked"), F.lit(tasks)) * F.col("_df") / PAIRS).cast("int")
    load = load.select(*key, pieces.alias("_pieces"))
    places = asked.select(*key, "_part").distinct().join(load, key).withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))).drop("_pieces")
    held = postings.join(load, key).withColumn("_piece", F.pmod(F.xxhash64("candidate_entity_id"), F.col("_pieces")).cast("int"))
    held = held.select(*key, "_piece", "candidate_entity_id").join(places, [*key, "_piece"]).drop("_piece")
    found = asked.select(*key, "_part", "source1_entity_id", (F.col("idf") * unit).cast("long").alias("_value")).repartition(tasks, "_part").join(held.repartition(tasks, "_part"), ["_part", *key])
    pairs = found.groupBy("_part", "source1_entity_id", "candidate_entity_id").agg(F.sum("_value").alias("_sum"))
    return pairs.select("_part", "source1_entity_id", "candidate_entity_id", (F.floor(F.col("_sum").cast("double") / unit * 1e6 + 0.5) / 1e6).alias("score"))


@contextmanager
def joined_in_parts(spark: SparkSession) -> Iterator[None]:
    """Joins that run meanwhile stay in partitions by some of their keys; else Spark deals both sides out by all keys, and pairs by theirs."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def best_rows(near: DataFrame, pool_members: DataFrame, k: int) -> DataFrame:
    """The k best pool rows of each class of queries, from its k best classes, near."""
    order = Window.partitionBy("class").orderBy("entity_id")
    first = pool_members.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).select(F.col("class").alias("candidate_entity_id"), F.col("entity_id").alias("_row"))
    got = near.select("source1_entity_id", "candidate_entity_id", "score").join(first, "candidate_entity_id")
    return ranked(got.select("source1_entity_id", F.col("_row").alias("candidate_entity_id"), "score"), k)


def of_members(best: DataFrame, query_members: DataFrame, k: int, sides: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """What the classes of queries have found, for each query; query_members is stored.

    sides: queries and pool, for the columns of features.with_sides(), which are joined to classes, not to their many pairs.
    """
    more = []
    if sides:
        query_members = stored(features.with_side(query_members, sides[0], "entity_id", "s1"), "sides")
        best = features.with_side(best, sides[1], "candidate_entity_id", "c")
        more = ["s1_name", "s1_address", "c_name", "c_address"]
    tasks = max(int(best.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-query_members.count() * k // PAIRS))
    got = query_members.repartition(tasks, "class").join(best.withColumnRenamed("source1_entity_id", "class").repartition(tasks, "class").hint("merge"), "class")
    return got.select(F.col("entity_id").alias("source1_entity_id"), "candidate_entity_id", "score", "blocking_rank", *more)


def block_topk(queries: DataFrame, pool: DataFrame, k: int = K, token_cap: int = TOKEN_CAP, df_cap: int = DF_CAP, sides: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """source1_entity_id, candidate_entity_id, score, blocking_rank by the sum of the idf of a query's rarest tokens that a pool row has.

    An id on several rows has the tokens of all. Queries without an indexed token have no rows. sides: see of_members().
    """
    return index_topk(queries, *token_index(pool, df_cap), k, token_cap, sides)


def class_tokens(entities: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes of rows with the same tokens, their members, and their tokens (entity_id, country, token, rows)."""
    words = F.array_join(F.array_sort(F.array_distinct(text.canonical_tokens("business_name", "business_address"))), " ")
    found, members = classes(entities, words)
    tokens = lambda rows: rows.where("words <> ''").select("entity_id", "country", F.explode(F.split("words", " ")).alias("token"), "rows")
    return found, members, tokens(found.where("not alone")).unionByName(tokens(found.where("alone")).distinct())


def token_index(pool: DataFrame, df_cap: int = DF_CAP) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of the pool's classes the tokens (entity_id, country, token, rows), stored, their idf, and the members."""
    found, members, tokens = class_tokens(pool)
    tokens = stored(tokens, "tokens")
    return tokens, token_idf(tokens, country_sizes(found), df_cap), members


def index_topk(queries: DataFrame, tokens: DataFrame, idf: DataFrame, members: DataFrame, k: int = K, token_cap: int = TOKEN_CAP, sides: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """block_topk with an index of the pool."""
    rare = Window.partitionBy("entity_id").orderBy(F.desc("idf"), "token")
    _, own, words = class_tokens(queries)
    asked = words.join(idf, ["country", "token"]).withColumn("_n", F.row_number().over(rare)).where(F.col("_n") <= token_cap)
    asked = stored(asked.select(F.col("entity_id").alias("source1_entity_id"), "country", "token", "idf"), "asked")
    near = ranked(summed(asked, tokens.select(F.col("entity_id").alias("candidate_entity_id"), "country", "token"), token_cap), k, "_part")
    with joined_in_parts(queries.sparkSession):
        near = stored(near.select("source1_entity_id", "candidate_entity_id", "score"), "near")
    return of_members(best_rows(near, members, k), own, k, sides)


def tfidf_vectors(pool: DataFrame, queries: DataFrame, body: Column, terms: Callable[[str], Column], min_df: int = MIN_DF, vocabulary: int | None = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """Rows entity_id, country, token, term (its number), weight of pool and queries, vectors of length 1, stored.

    Weight: (1 + ln tf) idf. The vocabulary of a country is its most frequent terms, ties to the lesser term, that stand on
    min_df pool rows or more; queries keep only these. Where entities have a column rows, each stands for so many.
    """

    def counted(entities: DataFrame) -> DataFrame:
        rows = entities.where(F.col("country").isNotNull()).select("entity_id", "country", body.alias("_body"), rows_of(entities).alias("rows"))
        rows = rows.select("entity_id", "country", "rows", F.explode(terms("_body")).alias("token"))
        return rows.groupBy("entity_id", "country", "rows", "token").agg(F.count("*").alias("tf"))

    counts = stored(counted(pool), "terms")
    sizes = country_sizes(pool)
    stats = counts.groupBy("country", "token").agg(F.sum("rows").alias("df"), F.sum(F.col("rows") * F.col("tf")).alias("_all")).where(F.col("df") >= min_df)
    if vocabulary is not None:
        stats = stored(stats, "vocabulary")
        if stats.groupBy("country").count().where(F.col("count") > vocabulary).limit(1).count():
            stats = first_rows(stats, ["country"], F.struct(-F.col("_all"), F.left("token", F.lit(2))), [F.desc("_all"), F.col("token")], vocabulary)
    idf = stats.join(sizes, "country").select("country", "token", (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1).alias("idf"))
    idf = stored(idf.withColumn("term", F.monotonically_increasing_id()), "idf")

    def weighed(rows: DataFrame) -> DataFrame:
        rows = rows.join(idf, ["country", "token"]).withColumn("_w", (1 + F.log("tf")) * F.col("idf"))
        norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy("entity_id")))
        return stored(rows.select("entity_id", "country", "token", "term", F.round(F.col("_w") / norm, 9).alias("weight")), "vectors")

    return weighed(counts), weighed(counted(queries))


def _compared(queries: pd.DataFrame, pool: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of pool for each of queries (entity_id, terms, weights), with a rounded score above 0, ties to the lesser id."""
    pool = pool.sort_values("entity_id")
    ids = pool["entity_id"].to_numpy()
    terms, weights = np.concatenate(pool["terms"].to_list()), np.concatenate(pool["weights"].to_list())
    order = np.argsort(terms, kind="stable")
    owners = np.repeat(np.arange(len(ids)), [len(t) for t in pool["terms"]])[order]
    weights = weights[order]
    known, first = np.unique(terms[order], return_index=True)
    last = np.append(first[1:], len(terms))
    out: tuple[list, list, list] = ([], [], [])
    for own, asked, given in zip(queries["entity_id"], queries["terms"], queries["weights"], strict=True):
        at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
        found = [(first[i], last[i], w) for i, t, w in zip(at, asked, given, strict=True) if known[i] == t]
        if not found:
            continue
        sums = np.bincount(np.concatenate([owners[a:b] for a, b, _ in found]), np.concatenate([weights[a:b] * w for a, b, w in found]), len(ids))
        units = np.floor(sums * 1e6 + 0.5).astype(np.int64)
        place = units * len(ids) + np.arange(len(ids))[::-1]
        best = np.argpartition(place, -k)[-k:] if k < len(ids) else np.arange(len(ids))
        best = best[units[best] > 0]
        out[0].extend([own] * len(best))
        out[1].extend(ids[best])
        out[2].extend(units[best] / 1e6)
    return pd.DataFrame(dict(zip(("source1_entity_id", "candidate_entity_id", "score"), out, strict=True)))


def cosine_best(pool_vectors: DataFrame, query_vectors: DataFrame, k: int) -> DataFrame:
    """source1_entity_id, candidate_entity_id, score above 0, blocking_rank: the k best of the sparse product.

    Terms that nearly all rows have make nearly all pairs, so blocks of queries are compared with blocks of the pool, and only
    the k best of each leave a task.
    """

    def packed(vectors: DataFrame) -> DataFrame:
        rows = vectors.groupBy("entity_id", "country").agg(F.collect_list(F.struct("term", "weight")).alias("_v"))
        return stored(rows.select("entity_id", "country", F.col("_v.term").alias("terms"), F.col("_v.weight").alias("weights")), "packed")

    asked, pool = packed(query_vectors), packed(pool_vectors)
    blocks = lambda df, name, size: df.groupBy("country").agg(F.ceil(F.count("*") / size).cast("int").alias(name))
    sizes = stored(blocks(asked, "_qs", QUERY_BLOCK).join(blocks(pool, "_ps", POOL_BLOCK), "country"), "blocks")
    key = ["country", "_q", "_p"]
    tasks = max(1, sizes.agg(F.coalesce(F.sum(F.col("_qs") * F.col("_ps")), F.lit(0))).first()[0])

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        count = {"_q": "_qs", "_p": "_ps"}
        df = df.join(sizes, "country").withColumn(own, F.pmod(F.xxhash64("entity_id"), F.col(count[own])).cast("int"))
        df = df.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(count[other]) - 1)))
        return df.select(*key, "entity_id", "terms", "weights").repartition(tasks, *key)

    def run(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        if one.empty or two.empty:
            return pd.DataFrame({"source1_entity_id": [], "candidate_entity_id": [], "score": []})
        return _compared(one, two, k)

    pairs = dealt(asked, "_q", "_p").groupBy(*key).cogroup(dealt(pool, "_p", "_q").groupBy(*key))
    return ranked(pairs.applyInPandas(run, "source1_entity_id string, candidate_entity_id string, score double"), k)


def tfidf_topk(queries: DataFrame, pool: DataFrame, k: int = TFIDF_K, min_df: int = MIN_DF, vocabulary: int | None = VOCABULARY, fold: bool = True) -> DataFrame:
    """Mode B's candidates: cosine over words and pairs of words."""
    (there, members), (asked, own) = classes(pool, tfidf_text(fold)), classes(queries, tfidf_text(fold))
    vectors = tfidf_vectors(there, asked, F.col("words"), text.word_ngrams, min_df, vocabulary)
    return of_members(best_rows(cosine_best(*vectors, k), members, k), own, k)


def best_match(queries: DataFrame, pool: DataFrame, least: float = 0.76, min_df: int = 2, fold: bool = True) -> DataFrame:
    """Mode C: the best candidate of each query, if its cosine is least or more."""
    return tfidf_topk(queries, pool, 1, min_df, fold=fold).where(F.col("score") >= least)


def charwb_knn(queries: DataFrame, pool: DataFrame, k: int = K) -> DataFrame:
    """Mode D's candidates: cosine over 3- to 5-grams of characters inside words.

    A query whose country the pool lacks is compared with the whole pool. Where fewer than k rows share an n-gram with a
    query, the smallest other ids of its part fill up with score 0: ids of the pool are ranked once for each part, and a
    query that found m rows needs at most the k + m first of them.
    """
    known = lambda df: df.withColumn("country", text.country_or_unknown("country"))
    queries, pool = known(queries), known(pool)
    there = pool.select("country").distinct()
    inside, outside = queries.join(there, "country", "left_semi"), queries.join(there, "country", "left_anti")
    body = text.combined(text.clean_expanded("business_name"), text.clean_expanded("business_address"), trim=True)
    part = pool.unionByName(pool.withColumn("country", F.lit("*"))) if not outside.isEmpty() else pool
    asked = inside.unionByName(outside.withColumn("country", F.lit("*")))
    (rows, members), (asked, own) = classes(part, body), classes(asked, body)
    vectors = tfidf_vectors(rows, asked, F.col("words"), text.char_wb_ngrams, 1, None)
    found = stored(best_rows(cosine_best(*vectors, k), members, k), "found")
    order = Window.partitionBy("country").orderBy("entity_id")
    first = part.select("country", "entity_id").withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= 2 * k).select("country", F.col("entity_id").alias("candidate_entity_id"))
    had = found.groupBy("source1_entity_id").agg(F.count("*").alias("_m"), F.collect_set("candidate_entity_id").alias("_ids"))
    lacking = asked.select(F.col("entity_id").alias("source1_entity_id"), "country").join(had, "source1_entity_id", "left").where(F.coalesce("_m", F.lit(0)) < k)
    fill = lacking.join(first, "country").where(F.col("_ids").isNull() | ~F.array_contains("_ids", F.col("candidate_entity_id")))
    fill = fill.select("source1_entity_id", "candidate_entity_id", F.lit(0.0).alias("score"))
    return of_members(ranked(found.select("source1_entity_id", "candidate_entity_id", "score").unionByName(fill), k), own, k)


def candidate_recall(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """candidate_recall (of all true pairs, how many are candidates), true_pairs, found_pairs, avg_candidates over all rows of truth."""
    own = candidates.groupBy("source1_entity_id").agg(F.collect_set("candidate_entity_id").alias("_c"))
    got = truth.join(own, "source1_entity_id", "left").withColumn("_c", F.coalesce("_c", F.array().cast("array<string>")))
    found, all_ = F.sum(F.size(F.array_intersect("_c", "matched"))), F.sum(F.size("matched"))
    return got.agg(F.round(F.when(all_ > 0, found / all_).otherwise(0.0), 6).alias("candidate_recall"), all_.alias("true_pairs"), found.alias("found_pairs"), F.round(F.avg(F.size("_c")), 6).alias("avg_candidates"))


def blocking_totals(candidates: DataFrame, queries: DataFrame) -> DataFrame:
    """queries, candidates, avg_candidates, empty_queries."""
    own = candidates.groupBy("source1_entity_id").agg(F.count("*").alias("_n"))
    got = queries.select(F.col("entity_id").alias("source1_entity_id")).join(own, "source1_entity_id", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    return got.agg(F.count("*").alias("queries"), F.sum("_n").alias("candidates"), F.round(F.avg("_n"), 6).alias("avg_candidates"), F.count_if(F.col("_n") == 0).alias("empty_queries"))
