"""The queries of the linkage operators over the test tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import features, text
from tessera.functions import similarity as sim
from tessera.operators import assign, blocking, labels, metrics, validate
from tessera.plans import linkage
from tessera.plans import similarity_sql as sql_of
from tessera.sources import sinks, tables
from tessera.sources.shared import new_path, remove, shuffle_files_dropped, spread, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# --- SQL shared by the queries -------------------------------------------------------------------------------------------

DOCUMENTS = """
ents AS (SELECT 'S' || (substr(source, 4)::INT % 3 + 1) || '-' || doc_id AS entity_id, split_part(text, chr(10), 1) AS business_name,
  substr(text, length(split_part(text, chr(10), 1)) + 2) AS business_address, lang AS country FROM documents)"""
PARTS = """
ents AS (SELECT 'S' || (p_partkey % 3 + 1) || '-' || p_partkey AS entity_id, p_name AS business_name, p_brand || ' ' || p_size AS business_address,
  p_type AS country FROM part)"""


def sql_plain(c: str) -> str:
    return f"regexp_replace(lower(coalesce({c}, '')), '[^a-z0-9\\s]', ' ', 'g')"


def sql_collapse(c: str) -> str:
    return f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"


def sql_replaced(c: str, forms: tuple[tuple[str, str], ...]) -> str:
    for word, to in forms:
        c = f"regexp_replace({c}, '\\b{word}\\b', '{to}', 'g')"
    return c


def sql_canonical(c: str) -> str:
    return sql_replaced(sql_collapse(sql_plain(c)), text.SHORT_FORMS)


def sql_expanded(c: str) -> str:
    return sql_collapse(sql_replaced(sql_plain(c), text.LONG_FORMS))


def sql_name(c: str) -> str:
    """DuckDB's word boundaries are those of ASCII; letters beyond, which become blanks later, first turn into an ASCII word character."""
    low = f"regexp_replace(lower(coalesce({c}, '')), '[À-ÖØ-öø-ɏ]', '_', 'g')"
    return sql_collapse(sql_plain(f"regexp_replace({low}, '\\b(?:{'|'.join(text.COMPANY_WORDS)})\\b', '', 'g')"))


def sql_address(c: str) -> str:
    return sql_collapse(sql_replaced(sql_plain(c), text.ADDRESS_FORMS))


def sql_blocking(entities: str) -> str:
    return f"""{entities},
src AS (SELECT *, entity_id LIKE 'S1-%' AS is_query, {sql_canonical("business_name")} || ' ' || {sql_canonical("business_address")} AS body FROM ents),
toks AS (SELECT DISTINCT entity_id, country, is_query, unnest(list_filter(string_split_regex(body, '\\s+'), lambda t: length(t) >= 2)) AS token FROM src),
sizes AS (SELECT country, count(*) AS n FROM src WHERE NOT is_query GROUP BY country),
idf AS (SELECT country, token, count(*) AS df, round(ln((n + 1) / (count(*) + 1)) + 1, 9) AS idf FROM toks JOIN sizes USING (country)
  WHERE NOT is_query GROUP BY country, token, n HAVING count(*) <= {blocking.DF_CAP}),
asked AS (SELECT * FROM (SELECT entity_id, country, token, idf, row_number() OVER (PARTITION BY entity_id ORDER BY idf DESC, token) AS rn
  FROM toks JOIN idf USING (country, token) WHERE is_query) WHERE rn <= {blocking.TOKEN_CAP}),
scores AS (SELECT a.entity_id AS source1_entity_id, p.entity_id AS candidate_entity_id, round(sum(a.idf), 6) AS score
  FROM asked a JOIN toks p USING (country, token) WHERE NOT p.is_query GROUP BY ALL),
cands AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source1_entity_id ORDER BY score DESC, candidate_entity_id)::INT AS blocking_rank
  FROM scores) WHERE blocking_rank <= {blocking.K})"""


TRUTH = """
keyed AS (SELECT entity_id, country, {key} AS k FROM ents),
truth_pairs AS (SELECT q.entity_id AS source1_entity_id, p.entity_id AS candidate_entity_id FROM keyed q JOIN keyed p
  ON q.country = p.country AND q.k = p.k WHERE q.entity_id LIKE 'S1-%' AND p.entity_id NOT LIKE 'S1-%' AND q.k <> ''),
qs AS (SELECT entity_id AS source1_entity_id FROM ents WHERE entity_id LIKE 'S1-%')"""
DOC_TRUTH = TRUTH.format(key=f"{sql_canonical('business_name')} || ' ' || {sql_canonical('business_address')}")
#: Parts are the same if name and brand, the address's first word, are.
PART_TRUTH = TRUTH.format(key=f"""{sql_canonical('business_name')} || ' ' || {sql_canonical("split_part(business_address, ' ', 1)")}""")
#: A stand-in for a model's probability, from the blocking score: what SQL can also compute.
SQL_CLAIMS = "claims AS (SELECT source1_entity_id, candidate_entity_id, blocking_rank, round(score / max(score) OVER (), 6) AS probability FROM cands)"


def truth_of(queries: DataFrame, pool: DataFrame, body: Callable[[], F.Column] = blocking.blocking_text) -> DataFrame:
    """source1_entity_id, matched: pool rows of the same country whose cleaned text is the same, listed once for each text. A query id on several rows has those of all."""
    keyed = lambda df: df.select("entity_id", "country", body().alias("k"))
    lists = keyed(pool).where("k <> ''").groupBy("country", "k").agg(F.array_sort(F.collect_list("entity_id")).alias("matched"))
    lists = stored(lists.withColumn("_set", F.monotonically_increasing_id()), "lists")
    of = keyed(queries).join(lists.select("country", "k", "_set"), ["country", "k"], "left").select(F.col("entity_id").alias("source1_entity_id"), "_set")
    got = labels.with_lists(stored(of, "sets"), lists.select("_set", "matched"))
    more = stored(queries.groupBy("entity_id").count().where("count > 1").select(F.col("entity_id").alias("source1_entity_id")), "repeated")
    if more.isEmpty():
        return got
    own = got.join(more, "source1_entity_id", "left_semi")
    all_ = own.groupBy("source1_entity_id").agg(F.array_sort(F.flatten(F.collect_list("matched"))).alias("matched"))
    return got.join(more, "source1_entity_id", "left_anti").unionByName(own.select("source1_entity_id").join(all_, "source1_entity_id"))


def part_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.block_topk(*tables.part_sides(spark, sf_dir))


def listed_candidates(queries: DataFrame, pool: DataFrame) -> DataFrame:
    """source1_entity_id, ids: the candidates of each row of queries by rank, listed once for each text."""
    few, members = tables.one_of_each_text(queries)
    lists = assign.collected(blocking.block_topk(few, pool), few.select("entity_id").distinct(), "blocking_rank")
    lists = stored(lists.withColumnRenamed("source1_entity_id", "_as"), "lists")
    return queries.select("entity_id").join(stored(members, "members"), "entity_id").join(lists, "_as").select(F.col("entity_id").alias("source1_entity_id"), "ids")


def part_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims_of(stored(part_candidates(spark, sf_dir), "candidates"))


def claims_of(got: DataFrame) -> DataFrame:
    """Stored candidates as claims."""
    most = got.agg(F.max("score").alias("_most"))
    kept = [c for c in got.columns if c != "score"]
    return got.crossJoin(F.broadcast(most)).select(*kept, F.round(F.col("score") / F.col("_most"), 6).alias("probability"))  # one row


def name_and_brand() -> F.Column:
    return text.combined(text.clean_canonical("business_name"), text.clean_canonical(F.substring_index("business_address", " ", 1)))


def part_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truth_of(*tables.part_sides(spark, sf_dir), name_and_brand)


def part_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, pool = tables.part_sides(spark, sf_dir)
    return blocking.block_topk(queries, pool, sides=(queries, pool))


SQL_PAIRS = f"""WITH {sql_blocking(PARTS)},
pairs AS (SELECT c.source1_entity_id, c.candidate_entity_id, c.blocking_rank, c.score, a.business_name AS n1, a.business_address AS a1, b.business_name AS n2,
  b.business_address AS a2 FROM cands c JOIN ents a ON a.entity_id = c.source1_entity_id JOIN ents b ON b.entity_id = c.candidate_entity_id)"""

# --- scans, cleaning -----------------------------------------------------------------------------------------------------


@query("SELECT DISTINCT lang AS country FROM documents WHERE lang <> ''")
def available_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.available_countries(tables.document_entities(spark, sf_dir))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def _cleaned(name: str, sql: Callable[[str], str], column: Callable[[str], F.Column]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return texts(spark, sf_dir).select("doc_id", column("text").alias("cleaned"))

    run.__name__ = name
    query(f"SELECT doc_id, {sql('text')} AS cleaned FROM documents")(run)


_cleaned("clean_canonical", sql_canonical, text.clean_canonical)
_cleaned("clean_expand", sql_expanded, text.clean_expanded)
_cleaned("clean_address", sql_address, lambda c: text.clean_address(c, False))
_cleaned("clean_name", sql_name, lambda c: text.clean_name(c, False))
_cleaned("feature_text", lambda c: f"regexp_replace(lower(coalesce({c}, '')), '^\\s+|\\s+$', '', 'g')", text.feature_text)


@query("SELECT doc_id, array_to_string(regexp_extract_all(coalesce(text, ''), '[0-9]+'), '|') AS digits FROM documents")
def digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("doc_id", F.array_join(text.digits("text"), "|").alias("digits"))


@query("SELECT doc_id, array_to_string(list_filter(string_split_regex(coalesce(text, ''), '\\s+'), lambda t: length(t) >= 2), '|') AS tokens FROM documents")
def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("doc_id", F.array_join(text.tokens("text"), "|").alias("tokens"))


@query("""SELECT p_partkey, CASE WHEN d = '' THEN '' ELSE array_to_string(list_transform(range(1, greatest(length(d) - 2, 1) + 1), lambda i: substr(d, i, 3)), '|') END AS ngrams
FROM (SELECT p_partkey, replace(coalesce(p_name, ''), ' ', '') AS d FROM part)""")
def char_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", F.array_join(text.char_ngrams("p_name"), "|").alias("ngrams"))


@query(f"SELECT doc_id, CASE WHEN c <> '' THEN 'nt1:' || split_part(c, ' ', 1) END AS block_key FROM (SELECT doc_id, {sql_name('text')} AS c FROM documents)")
def block_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(spark, sf_dir)
    return docs.select("doc_id", text.block_key(text.clean_name("text", False)).alias("block_key"))


def sql_folded(c: str) -> str:
    return f"strip_accents(coalesce({c}, ''))"


_cleaned("clean_address_folded", lambda c: sql_address(sql_folded(c)), text.clean_address)
_cleaned("clean_name_folded", lambda c: sql_name(sql_folded(c)), text.clean_name)
_cleaned("strip_accents", sql_folded, text.strip_accents)


@query(f"SELECT doc_id, CASE WHEN c <> '' THEN 'nt1:' || split_part(c, ' ', 1) END AS block_key FROM (SELECT doc_id, {sql_name(sql_folded('text'))} AS c FROM documents)")
def block_key_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir).select("doc_id", text.block_key(text.clean_name("text")).alias("block_key"))


# --- index and candidates ------------------------------------------------------------------------------------------------


@query(f"WITH {sql_blocking(DOCUMENTS)} SELECT source1_entity_id, candidate_entity_id, score, blocking_rank FROM cands")
def block_topk_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.block_topk(*tables.document_sides(spark, sf_dir))


@query(f"WITH {sql_blocking(PARTS)} SELECT source1_entity_id, candidate_entity_id, score, blocking_rank FROM cands")
def block_topk_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_candidates(spark, sf_dir)


@query(f"WITH {sql_blocking(DOCUMENTS)} SELECT country, token, df, idf FROM idf")
def idf_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, pool = tables.document_sides(spark, sf_dir)
    return blocking.token_idf(blocking.entity_tokens(pool), blocking.country_sizes(pool))


@query(f"WITH {sql_blocking(PARTS)} SELECT entity_id, country, token, df, idf FROM toks JOIN idf USING (country, token) WHERE NOT is_query")
def postings_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, pool = tables.part_sides(spark, sf_dir)
    tokens = blocking.entity_tokens(pool)
    return blocking.postings(tokens, blocking.token_idf(tokens, blocking.country_sizes(pool))).select("entity_id", "country", "token", "df", "idf")


@query(f"""WITH {sql_blocking(DOCUMENTS)}, {DOC_TRUTH},
t AS (SELECT count(*) AS true_pairs, count(c.score) AS found_pairs FROM truth_pairs LEFT JOIN cands c USING (source1_entity_id, candidate_entity_id))
SELECT round(found_pairs / true_pairs, 6) AS candidate_recall, true_pairs, found_pairs, round((SELECT count(*) FROM cands) / (SELECT count(*) FROM qs), 6) AS avg_candidates FROM t""")
def candidate_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, pool = tables.document_sides(spark, sf_dir)
    return blocking.candidate_recall(blocking.block_topk(queries, pool), truth_of(queries, pool))


@query(f"""WITH {sql_blocking(PARTS)}, n AS (SELECT e.entity_id, count(c.score) AS n FROM ents e LEFT JOIN cands c ON c.source1_entity_id = e.entity_id
WHERE e.entity_id LIKE 'S1-%' GROUP BY 1)
SELECT count(*) AS queries, sum(n)::BIGINT AS candidates, round(avg(n), 6) AS avg_candidates, count(*) FILTER (n = 0) AS empty_queries FROM n""")
def empty_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, _ = tables.part_sides(spark, sf_dir)
    return blocking.blocking_totals(part_candidates(spark, sf_dir), queries)


def sql_tfidf(entities: str, terms: str, min_df: int, vocabulary: int | None, k: int) -> str:
    limit = f"WHERE rn <= {vocabulary}" if vocabulary else ""
    return f"""{entities},
src AS (SELECT entity_id, country, entity_id LIKE 'S1-%' AS is_query, {terms} AS terms FROM ents),
tf AS (SELECT entity_id, country, is_query, token, count(*) AS tf FROM (SELECT entity_id, country, is_query, unnest(terms) AS token FROM src) GROUP BY ALL),
sizes AS (SELECT country, count(*) AS n FROM src WHERE NOT is_query GROUP BY country),
stats AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY total DESC, token) AS rn FROM (SELECT country, token, count(*) AS df, sum(tf) AS total
  FROM tf WHERE NOT is_query GROUP BY ALL HAVING count(*) >= {min_df})),
idf AS (SELECT country, token, ln((n + 1) / (df + 1)) + 1 AS idf FROM (SELECT * FROM stats {limit}) JOIN sizes USING (country)),
w AS (SELECT entity_id, country, is_query, token, (1 + ln(tf)) * idf AS w FROM tf JOIN idf USING (country, token)),
v AS (SELECT entity_id, country, is_query, token, round(w / sqrt(sum(w * w) OVER (PARTITION BY entity_id)), 9) AS weight FROM w),
scores AS (SELECT * FROM (SELECT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id, round(sum(a.weight * b.weight), 6) AS score
  FROM v a JOIN v b USING (country, token) WHERE a.is_query AND NOT b.is_query GROUP BY ALL) WHERE score > 0),
cands AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source1_entity_id ORDER BY score DESC, candidate_entity_id)::INT AS blocking_rank FROM scores)
  WHERE blocking_rank <= {k})"""


_WORDS = f"regexp_extract_all(trim({sql_name('business_name')} || ' ' || {sql_address('business_address')}), '\\b\\w\\w+\\b')"
WORD_NGRAMS = f"list_concat({_WORDS}, list_transform(range(1, len({_WORDS})), lambda i: {_WORDS}[i] || ' ' || {_WORDS}[i + 1]))"


@query(f"WITH {sql_tfidf(PARTS, WORD_NGRAMS, blocking.MIN_DF, blocking.VOCABULARY, blocking.TFIDF_K)} SELECT source1_entity_id, candidate_entity_id, score, blocking_rank FROM cands")
def tfidf_word_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.tfidf_topk(*tables.part_sides(spark, sf_dir))


@query(f"WITH {sql_tfidf(PARTS, WORD_NGRAMS, 2, blocking.VOCABULARY, 1)} SELECT source1_entity_id, candidate_entity_id, score, blocking_rank FROM cands WHERE score >= 0.76")
def tfidf_best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.best_match(*tables.part_sides(spark, sf_dir))


#: Words of three to five characters with their blanks; a query whose country the pool lacks stands in the country *, with the whole pool.
_PADDED = f"list_transform(list_filter(string_split_regex(lower(trim({sql_expanded('business_name')} || ' ' || {sql_expanded('business_address')})), '\\s+'), lambda w: w <> ''), lambda w: ' ' || w || ' ')"
_CHAR_WB = f"""flatten(list_transform({_PADDED}, lambda w: flatten(list_transform([3, 4, 5], lambda n: CASE WHEN n > 3 AND length(w) < n THEN [] ELSE
  list_transform(range(1, greatest(length(w) - n + 1, 1) + 1), lambda i: substr(w, i, n)) END))))"""
_NEAR = PARTS.replace("ents AS", "raw AS") + """,
known AS (SELECT entity_id, business_name, business_address, upper(trim(coalesce(country, 'UNKNOWN'))) AS country, entity_id LIKE 'S1-%' AS is_query FROM raw),
there AS (SELECT DISTINCT country FROM known WHERE NOT is_query),
ents AS (SELECT entity_id, business_name, business_address, CASE WHEN is_query AND country NOT IN (SELECT country FROM there) THEN '*' ELSE country END AS country FROM known
  UNION ALL SELECT entity_id, business_name, business_address, '*' FROM known WHERE NOT is_query AND EXISTS (SELECT 1 FROM known WHERE is_query AND country NOT IN (SELECT country FROM there)))"""


@query(f"""WITH {sql_tfidf(_NEAR, _CHAR_WB, 1, None, blocking.K)},
pairs AS (SELECT q.entity_id AS source1_entity_id, p.entity_id AS candidate_entity_id, coalesce(s.score, 0) AS score FROM ents q JOIN ents p ON q.country = p.country
  LEFT JOIN scores s ON s.source1_entity_id = q.entity_id AND s.candidate_entity_id = p.entity_id WHERE q.entity_id LIKE 'S1-%' AND p.entity_id NOT LIKE 'S1-%')
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source1_entity_id ORDER BY score DESC, candidate_entity_id)::INT AS blocking_rank FROM pairs) WHERE blocking_rank <= {blocking.K}""")
def charwb_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocking.charwb_knn(*tables.part_sides(spark, sf_dir))


# --- pair features -------------------------------------------------------------------------------------------------------

def _pair_query(name: str, columns: dict[str, Callable[[], F.Column]], sql: dict[str, str]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        got = part_pairs(spark, sf_dir)
        return got.select("source1_entity_id", "candidate_entity_id", *[F.round(c().cast("double"), 6).alias(k) for k, c in columns.items()])

    run.__name__ = name
    digits, words = ", ".join(f"{sql_of.digits(a)} AS {d}" for a, d in (("a1", "d1"), ("a2", "d2"))), ", ".join(f"string_split_regex(lower({n}), '\\s+') AS {t}" for n, t in (("n1", "t1"), ("n2", "t2")))
    query(f"{SQL_PAIRS} SELECT source1_entity_id, candidate_entity_id, {sql_of.columns(sql)} FROM (SELECT *, {digits}, {words} FROM pairs)")(run)


def _similarity_query(name: str, kinds: dict[str, str]) -> None:
    """kinds: columns of similarities of the names."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        got = part_pairs(spark, sf_dir)
        return got.select("source1_entity_id", "candidate_entity_id", *[F.round(sim.column_of(k)(_n1(), _n2()), 6).alias(c) for c, k in kinds.items()])

    run.__name__ = name
    sims = sql_of.similarities("SELECT lower(n1) AS x, lower(n2) AS y FROM pairs")
    query(f"{SQL_PAIRS}, {sims} SELECT source1_entity_id, candidate_entity_id, {sql_of.columns(dict((c, k) for c, k in kinds.items()))} FROM pairs JOIN sims ON x = lower(n1) AND y = lower(n2)")(run)


_n1, _n2, _a1, _a2 = (lambda: F.lower("s1_name"), lambda: F.lower("c_name"), lambda: F.lower("s1_address"), lambda: F.lower("c_address"))
_d1, _d2 = lambda: text.digits("s1_address"), lambda: text.digits("c_address")
_t1, _t2 = lambda: text.tokens(_n1(), 1), lambda: text.tokens(_n2(), 1)


_pair_query("feat_levenshtein", {"address_levenshtein": lambda: sim.levenshtein_percent(_a1(), _a2())},
            {"address_levenshtein": "CASE WHEN greatest(length(a1), length(a2)) = 0 THEN 100 ELSE 100 * (1 - levenshtein(lower(a1), lower(a2)) / greatest(length(a1), length(a2))) END"})
_pair_query("feat_numbers", {"number_overlap": lambda: sim.number_overlap(F.array_distinct(_d1()), F.array_distinct(_d2())), "digits_jaccard": lambda: sim.digits_jaccard(F.array_distinct(_d1()), F.array_distinct(_d2())), "first_digit_match": lambda: sim.first_digit_match(_d1(), _d2())},
            {"number_overlap": sql_of.jaccard("d1", "d2", "-1"), "digits_jaccard": sql_of.jaccard("d1", "d2", "1"), "first_digit_match": "CASE WHEN len(d1) > 0 AND len(d2) > 0 AND d1[1] = d2[1] THEN 1 ELSE 0 END"})
_pair_query("feat_veto", {"veto_flag": lambda: sim.veto(_d1(), _d2())}, {"veto_flag": sql_of.VETO})
_pair_query("feat_house_conflict", {"house_conflict": lambda: sim.house_conflict(_d1(), _d2())}, {"house_conflict": sql_of.HOUSE})
_pair_query("feat_lengths", {"len_diff_name": lambda: sim.relative_length_difference(_n1(), _n2()), "len_diff_addr": lambda: sim.relative_length_difference(_a1(), _a2()), "name_len_diff": lambda: F.abs(F.length(_n1()) - F.length(_n2())), "name_len_ratio": lambda: sim.length_ratio(_n1(), _n2())},
            {"len_diff_name": "abs(length(n1) - length(n2)) / greatest(length(n1), length(n2), 1)", "len_diff_addr": "abs(length(a1) - length(a2)) / greatest(length(a1), length(a2), 1)", "name_len_diff": "abs(length(n1) - length(n2))", "name_len_ratio": "least(length(n1), length(n2)) / greatest(length(n1), length(n2))"})
_pair_query("feat_token_jaccard", {"name_token_overlap": lambda: sim.set_jaccard(_t1(), _t2(), 1.0)}, {"name_token_overlap": sql_of.jaccard("t1", "t2", "1")})
_pair_query("feat_misc", {"first_char_match": lambda: sim.first_char_match(_n1(), _n2()), "is_source2": lambda: F.when(F.col("candidate_entity_id").startswith("S2-"), 1).otherwise(0), "addr_is_null": lambda: F.when(F.col("s1_address") == "", 1).otherwise(0), "rank": lambda: F.col("blocking_rank")},
            {"first_char_match": "CASE WHEN n1[1] = n2[1] THEN 1 ELSE 0 END", "is_source2": "CASE WHEN candidate_entity_id LIKE 'S2-%' THEN 1 ELSE 0 END", "addr_is_null": "CASE WHEN a1 = '' THEN 1 ELSE 0 END", "rank": "blocking_rank"})
_similarity_query("feat_ratio", {"name_ratio": "ratio"})
_similarity_query("feat_token_sort", {"name_token_sort_ratio": "token_sort_ratio"})
_similarity_query("feat_token_set", {"name_token_set_ratio": "token_set_ratio"})
_similarity_query("feat_jaro_winkler", {"name_jaro_winkler": "jaro_winkler"})
_similarity_query("feat_partial", {"name_partial_ratio": "partial_ratio", "name_wratio": "wratio"})


@query(sql_of.mode_a(SQL_PAIRS))
def features_mode_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.mode_a(part_pairs(spark, sf_dir))


@query(sql_of.mode_b(SQL_PAIRS, sql_name(sql_folded("{}")), sql_address(sql_folded("{}"))))
def features_mode_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.mode_b(part_pairs(spark, sf_dir))


@query(sql_of.mode_d(SQL_PAIRS, sql_expanded("{}")))
def features_mode_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.mode_d(part_pairs(spark, sf_dir))


# --- labels, decisions, metrics ------------------------------------------------------------------------------------------

SQL_CLAIMED = f"WITH {sql_blocking(PARTS)}, {SQL_CLAIMS}, {PART_TRUTH}"
SQL_LABELLED = f"{SQL_CLAIMED}, lab AS (SELECT c.*, CASE WHEN t.source1_entity_id IS NULL THEN 0 ELSE 1 END AS label FROM claims c LEFT JOIN truth_pairs t USING (source1_entity_id, candidate_entity_id))"
SQL_ASSIGNED = "best AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY candidate_entity_id ORDER BY probability DESC, source1_entity_id) AS rn FROM claims) WHERE rn = 1)"


def part_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.labelled(part_claims(spark, sf_dir), part_truth(spark, sf_dir))


@query(f"{SQL_LABELLED} SELECT source1_entity_id, candidate_entity_id, blocking_rank, probability, label FROM lab")
def label_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_labels(spark, sf_dir)


@query(f"""{SQL_LABELLED} SELECT source1_entity_id, candidate_entity_id, blocking_rank, label FROM (SELECT *, row_number() OVER (PARTITION BY source1_entity_id, label
ORDER BY blocking_rank, candidate_entity_id) AS rn FROM lab) WHERE label = 1 OR rn <= 5""")
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.hard_negatives(part_labels(spark, sf_dir)).select("source1_entity_id", "candidate_entity_id", "blocking_rank", "label")


@query(f"{SQL_LABELLED} SELECT label, count(*) AS pairs FROM lab GROUP BY label")
def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.class_balance(part_labels(spark, sf_dir))


@query(f"{SQL_CLAIMED} SELECT source1_entity_id, candidate_entity_id FROM cands UNION SELECT source1_entity_id, candidate_entity_id FROM truth_pairs")
def with_true_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.with_true_pairs(part_candidates(spark, sf_dir), part_truth(spark, sf_dir))


@query(f"WITH {DOCUMENTS} SELECT entity_id, substr(md5('42:' || entity_id), 1, 8) < '{int(0.8 * 16**8):08x}' AS in_train FROM ents")
def split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.document_entities(spark, sf_dir).select("entity_id", labels.in_share("entity_id", 0.8).alias("in_train"))


@query(f"WITH {DOCUMENTS} SELECT entity_id, country FROM ents ORDER BY md5('42:' || entity_id), entity_id LIMIT 100")
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.sample(tables.document_entities(spark, sf_dir), 100).select("entity_id", "country")


@query(f"""WITH {PARTS}, {PART_TRUTH}, p AS (SELECT DISTINCT candidate_entity_id AS entity_id FROM truth_pairs),
o AS (SELECT *, row_number() OVER (PARTITION BY substr(entity_id, 1, 3) ORDER BY md5('42:' || entity_id), entity_id) AS rn FROM ents
  WHERE entity_id NOT LIKE 'S1-%' AND entity_id NOT IN (SELECT entity_id FROM p))
SELECT entity_id FROM p UNION ALL SELECT entity_id FROM o WHERE rn <= {labels.DISTRACTORS}""")
def benchmark_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, pool = tables.part_sides(spark, sf_dir)
    return labels.benchmark_pool(pool, truth_of(queries, pool, name_and_brand)).select("entity_id")


@query(f"{SQL_CLAIMED}, {SQL_ASSIGNED} SELECT source1_entity_id, candidate_entity_id, probability FROM best")
def assign_pool_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign.assign_pool_unique(part_claims(spark, sf_dir)).select("source1_entity_id", "candidate_entity_id", "probability")


@query(f"{SQL_CLAIMED} SELECT source1_entity_id, candidate_entity_id, probability FROM claims WHERE blocking_rank = 1 AND probability >= 0.76")
def best_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign.best_single(part_claims(spark, sf_dir).withColumnRenamed("probability", "score"), 0.76).select("source1_entity_id", "candidate_entity_id", F.col("score").alias("probability"))


@query(f"""WITH {sql_blocking(PARTS)}, {SQL_CLAIMS}, j AS (SELECT c.*, regexp_extract_all(a.business_address, '[0-9]+') AS d1, regexp_extract_all(b.business_address, '[0-9]+') AS d2
FROM claims c JOIN ents a ON a.entity_id = c.source1_entity_id JOIN ents b ON b.entity_id = c.candidate_entity_id)
SELECT source1_entity_id, candidate_entity_id, round(CASE WHEN len(d1) > 0 AND len(d2) > 0 AND d1[1] <> d2[1] AND NOT list_contains(d2, d1[1]) AND NOT list_contains(d1, d2[1])
THEN probability * 0.5 ELSE probability END, 7) AS probability FROM j""")
def discount(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, pool = tables.part_sides(spark, sf_dir)
    pairs = stored(blocking.block_topk(queries, pool, sides=(queries, pool)).drop("s1_name", "c_name"), "candidates")
    got = claims_of(pairs).withColumn("house_conflict", sim.house_conflict(_d1(), _d2()))
    return assign.discounted(got).select("source1_entity_id", "candidate_entity_id", "probability")


SQL_F05 = "CASE WHEN p = 0 AND t = 0 THEN 1.0 WHEN h = 0 THEN 0.0 ELSE 1.25 * h / (0.25 * t + p) END"
SQL_COUNTS = """cnt AS (SELECT q.source1_entity_id, (SELECT count(*) FROM truth_pairs t WHERE t.source1_entity_id = q.source1_entity_id) AS t,
  (SELECT count(*) FROM m WHERE m.source1_entity_id = q.source1_entity_id) AS p,
  (SELECT count(*) FROM m JOIN truth_pairs t USING (source1_entity_id, candidate_entity_id) WHERE m.source1_entity_id = q.source1_entity_id) AS h,
  (SELECT count(*) FROM cands m JOIN truth_pairs t USING (source1_entity_id, candidate_entity_id) WHERE m.source1_entity_id = q.source1_entity_id) AS c FROM qs q)"""


@query(f"{SQL_CLAIMED}, {SQL_ASSIGNED}, m AS (SELECT * FROM best WHERE probability >= 0.88), {SQL_COUNTS} SELECT round(avg({SQL_F05}), 6) AS macro_f05 FROM cnt")
def macro_f05(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = assign.assign_pool_unique(part_claims(spark, sf_dir))
    return metrics.macro_f05(part_truth(spark, sf_dir), metrics.predictions(claims, 0.88))


SQL_SEARCH = f"""{SQL_CLAIMED}, {SQL_ASSIGNED}, grid AS (SELECT unnest(range(50, 97)) AS g),
tt AS (SELECT q.source1_entity_id, count(t.candidate_entity_id) AS t FROM qs q LEFT JOIN truth_pairs t USING (source1_entity_id) GROUP BY 1),
bl AS (SELECT b.*, t.source1_entity_id IS NOT NULL AS hit FROM best b LEFT JOIN truth_pairs t USING (source1_entity_id, candidate_entity_id)),
per AS (SELECT g, tt.source1_entity_id, tt.t, count(bl.candidate_entity_id) AS p, count(*) FILTER (bl.hit) AS h FROM grid CROSS JOIN tt
  LEFT JOIN bl ON bl.source1_entity_id = tt.source1_entity_id AND bl.probability >= g / 100 GROUP BY ALL),
search AS (SELECT g / 100 AS threshold, round(avg({SQL_F05}), 4) AS macro_f05 FROM per GROUP BY g)"""


@query(f"{SQL_SEARCH} SELECT threshold, macro_f05 FROM search")
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.threshold_search(part_claims(spark, sf_dir), part_truth(spark, sf_dir), assign=True)


@query(f"{SQL_SEARCH} SELECT threshold, macro_f05 FROM search ORDER BY macro_f05 DESC, threshold LIMIT 1")
def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_sweep(spark, sf_dir).orderBy(F.desc("macro_f05"), "threshold").limit(1)


@query(f"""{SQL_CLAIMED}, {SQL_ASSIGNED}, m AS (SELECT * FROM best WHERE probability >= 0.6), {SQL_COUNTS}
SELECT round(100.0 * sum(c) / sum(t), 6) AS blocking_recall, round(CASE WHEN sum(c) > 0 THEN 100.0 * sum(h) / sum(c) ELSE 0 END, 6) AS classifier_retention,
  round(CASE WHEN sum(p) > 0 THEN 100.0 * sum(h) / sum(p) ELSE 0 END, 6) AS micro_precision, round(100.0 * sum(h) / sum(t), 6) AS micro_recall,
  round(100.0 * coalesce(avg(h / p) FILTER (t > 0 AND p > 0), 0), 6) AS macro_precision, round(100.0 * coalesce(avg(h / t) FILTER (t > 0), 0), 6) AS macro_recall,
  round(100.0 * count(*) FILTER (t = 0 AND p = 0) / count(*) FILTER (t = 0), 6) AS singleton_accuracy, round(avg({SQL_F05}), 6) AS macro_f05 FROM cnt""")
def audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stored(part_candidates(spark, sf_dir), "candidates")
    claims = assign.assign_pool_unique(claims_of(found))
    return metrics.audit_summary(part_truth(spark, sf_dir), found, metrics.predictions(claims, 0.6))


# --- outputs, sets, joins ------------------------------------------------------------------------------------------------


@query(f"""WITH {sql_blocking(PARTS)} SELECT e.entity_id AS source1_entity_id, coalesce(string_agg(c.candidate_entity_id, ',' ORDER BY blocking_rank), '') AS candidate_entity_ids
FROM ents e LEFT JOIN cands c ON c.source1_entity_id = e.entity_id WHERE e.entity_id LIKE 'S1-%' GROUP BY 1""")
def complete_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, _ = tables.part_sides(spark, sf_dir)
    got = assign.collected(part_candidates(spark, sf_dir), queries, "blocking_rank")
    return got.select("source1_entity_id", F.array_join("ids", ",").alias("candidate_entity_ids"))


@query(f"WITH {sql_blocking(PARTS)} SELECT entity_id FROM ents WHERE entity_id LIKE 'S1-%' AND entity_id NOT IN (SELECT source1_entity_id FROM cands WHERE score >= 12)")
def anti_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, _ = tables.part_sides(spark, sf_dir)
    seen = part_candidates(spark, sf_dir).where("score >= 12").select(F.col("source1_entity_id").alias("entity_id"))
    return queries.select("entity_id").join(seen, "entity_id", "left_anti")


@query(f"WITH {PARTS} SELECT substr(entity_id, 1, 2) AS source, country, count(*) AS n FROM ents WHERE entity_id NOT LIKE 'S1-%' GROUP BY ALL")
def pool_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    ents = tables.part_entities(spark, sf_dir)
    both = tables.pool(ents.where(F.col("entity_id").startswith("S2-")), ents.where(F.col("entity_id").startswith("S3-")))
    return both.groupBy(F.substring("entity_id", 1, 2).alias("source"), "country").agg(F.count("*").alias("n"))


@query(f"""WITH {PARTS} SELECT * EXCLUDE (rn) FROM (SELECT business_name AS entity_id, business_address, country, row_number() OVER (PARTITION BY business_name
ORDER BY business_address, country) AS rn FROM ents) WHERE rn = 1""")
def dedupe_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    ents = tables.part_entities(spark, sf_dir).select(F.col("business_name").alias("entity_id"), "business_address", "country")
    return tables.first_of_each(ents)


@query(f"WITH {sql_blocking(PARTS)} SELECT * FROM ents WHERE entity_id IN (SELECT candidate_entity_id FROM cands)")
def semi_join_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = part_candidates(spark, sf_dir).select(F.col("candidate_entity_id").alias("entity_id"))
    return tables.only_ids(tables.part_entities(spark, sf_dir), ids)


# --- files: written to the shared folder and read again


@query(f"WITH {PARTS} SELECT entity_id, business_name, business_address, country FROM ents WHERE country IN ('STANDARD', 'PROMO')")
def entity_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of two countries from tab-separated files."""
    path = new_path(spark, "entities")
    sinks.write_tsv(tables.part_entities(spark, sf_dir).select("entity_id", "business_name", "business_address", "country"), path)
    return tables.read_entities(spark, path, ["STANDARD", "PROMO"])


SQL_LISTS = "(SELECT source1_entity_id, string_agg(candidate_entity_id, ',' ORDER BY {order}) AS ids FROM {table} GROUP BY 1)"


@query(f"""WITH {PARTS}, {PART_TRUTH} SELECT q.source1_entity_id, coalesce(ids, '') AS matched
FROM qs q LEFT JOIN {SQL_LISTS.format(order="candidate_entity_id", table="truth_pairs")} USING (source1_entity_id)""")
def ground_truth_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "truth")
    sinks.write_lists(part_truth(spark, sf_dir).withColumnRenamed("matched", "ids"), path, validate.MATCHING_HEADER, one_file=True)
    got = tables.read_truth(spark, path)
    return got.select("source1_entity_id", F.array_join(F.array_sort("matched"), ",").alias("matched"))


@query(f"WITH {PARTS} SELECT entity_id FROM ents WHERE entity_id LIKE 'S1-%'")
def ids_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids that the first column of a result file has."""
    path, (queries, _) = new_path(spark, "ids"), tables.part_sides(spark, sf_dir)
    sinks.write_lists(assign.collected(part_candidates(spark, sf_dir), queries, "blocking_rank"), path, validate.CANDIDATE_HEADER, one_file=True)
    return tables.read_ids(spark, path)


@query(f"""{SQL_CLAIMED}, {SQL_ASSIGNED}, m AS (SELECT * FROM best WHERE probability >= 0.6)
SELECT q.source1_entity_id || chr(9) || coalesce(ids, '') AS line FROM qs q LEFT JOIN {SQL_LISTS.format(order="probability DESC, candidate_entity_id", table="m")} USING (source1_entity_id)
UNION ALL SELECT 'source1_entity_id' || chr(9) || 'matched_entity_ids'""")
def matches_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a result file, ids by falling probability."""
    path, (queries, _) = new_path(spark, "matches"), tables.part_sides(spark, sf_dir)
    claims = assign.accepted(assign.assign_pool_unique(part_claims(spark, sf_dir)), 0.6)
    sinks.write_lists(assign.collected(claims, queries, "probability", False), path, validate.MATCHING_HEADER)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query(f"{SQL_SEARCH} SELECT threshold, macro_f05 FROM search ORDER BY macro_f05 DESC, threshold LIMIT 1")
def best_threshold_of_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "search")
    sinks.write_search(threshold_sweep(spark, sf_dir), path)
    search = tables.read_search(spark, path)
    return search.where(F.col("threshold") == tables.best_threshold(search))


@query(f"""{SQL_CLAIMED}, {SQL_ASSIGNED}, m AS (SELECT source1_entity_id, count(*) AS n FROM best WHERE probability >= 0.6 GROUP BY 1), a AS (SELECT coalesce(n, 0) AS n FROM qs LEFT JOIN m USING (source1_entity_id))
SELECT count(*) AS n_rows, count(*) FILTER (n = 0) AS n_empty, count(*) FILTER (n > 0) AS n_filled, sum(n)::BIGINT AS n_ids FROM a""")
def output_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, _ = tables.part_sides(spark, sf_dir)
    claims = assign.accepted(assign.assign_pool_unique(part_claims(spark, sf_dir)), 0.6)
    return metrics.output_counts(assign.collected(claims, queries))


@query(f"WITH {PARTS} SELECT entity_id, business_name FROM ents ORDER BY entity_id LIMIT 50")
def head_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.head(tables.part_entities(spark, sf_dir), 50).select("entity_id", "business_name")


@query(f"WITH {sql_blocking(DOCUMENTS)} SELECT country, count(DISTINCT token) AS tokens, count(DISTINCT entity_id) AS entities FROM toks GROUP BY country")
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = blocking.entity_tokens(tables.document_entities(spark, sf_dir))
    return tokens.groupBy("country").agg(F.count_distinct("token").alias("tokens"), F.count_distinct("entity_id").alias("entities"))


@query(f"""WITH {sql_blocking(PARTS)} SELECT c.source1_entity_id, c.candidate_entity_id, lower(e.business_name) AS c_name FROM cands c JOIN ents e ON e.entity_id = c.candidate_entity_id
WHERE e.country <> 'PROMO'""")
def pairs_with_pool_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates without a row in the pool are left out."""
    queries, pool = tables.part_sides(spark, sf_dir)
    got = features.with_sides(part_candidates(spark, sf_dir), queries, pool.where("country <> 'PROMO'"), inner=True)
    return got.select("source1_entity_id", "candidate_entity_id", F.lower("c_name").alias("c_name"))


@query(f"WITH {PARTS} SELECT entity_id FROM ents WHERE entity_id NOT LIKE 'S1-%'")
def match_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ents = tables.part_entities(spark, sf_dir)
    return tables.match_targets(*[ents.where(F.col("entity_id").startswith(s)) for s in ("S2-", "S3-")])


SQL_EXAMPLES = f"""SELECT source1_entity_id, candidate_entity_id, label::INT AS label, {", ".join(features.MODE_D)}
FROM ({SQL["features_mode_d"]}) JOIN ({SQL["hard_negatives"]}) USING (source1_entity_id, candidate_entity_id)"""


@query(SQL_EXAMPLES)
def training_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All true candidates and the hardest of the others, with mode D's features."""
    queries, pool = tables.part_sides(spark, sf_dir)
    # Queries of one text have the same candidates, labels and features.
    few, members = tables.one_of_each_text(queries)
    pairs = labels.hard_negatives(labels.labelled(blocking.block_topk(few, pool), truth_of(few, pool, name_and_brand)))
    got = linkage.pair_features(linkage.MODES["D"], pairs.select("source1_entity_id", "candidate_entity_id", "label"), few, pool)
    got = members.join(got.withColumnRenamed("source1_entity_id", "_as"), "_as").withColumnRenamed("entity_id", "source1_entity_id")
    return got.select("source1_entity_id", "candidate_entity_id", F.col("label").cast("int").alias("label"), *features.MODE_D)


@query(SQL_EXAMPLES)
def features_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "features")
    sinks.write_pairs(training_pairs(spark, sf_dir), path)
    return tables.read_features(spark, path, features.MODE_D)


@query(SQL["split_hash"])
def split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [new_path(spark, n) for n in ("fitting", "validation")]
    for part, path in zip(labels.split(tables.document_entities(spark, sf_dir).select("entity_id")), paths, strict=True):
        sinks.write_tsv(part, path)
    one, two = (tables.read_ids(spark, p) for p in paths)
    return one.withColumn("in_train", F.lit(True)).union(two.withColumn("in_train", F.lit(False)))


@query(f"""WITH {sql_blocking(PARTS)} SELECT c.source1_entity_id, c.candidate_entity_id, c.blocking_rank, e.country FROM cands c JOIN ents e ON e.entity_id = c.source1_entity_id
WHERE e.country IN ('STANDARD', 'PROMO')""")
def pairs_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of two countries, from a table with a folder for each."""
    path, (queries, _) = new_path(spark, "pairs"), tables.part_sides(spark, sf_dir)
    of = queries.select(F.col("entity_id").alias("source1_entity_id"), "country")
    sinks.write_pairs(part_candidates(spark, sf_dir).join(of, "source1_entity_id"), path, by_country=True)
    got = spark.read.parquet(path).where(F.col("country").isin("STANDARD", "PROMO"))
    return got.select("source1_entity_id", "candidate_entity_id", "blocking_rank", "country")


@query(f"""{SQL_CLAIMED}, tops AS (SELECT source1_entity_id, candidate_entity_id FROM cands WHERE blocking_rank <= 3),
off AS (SELECT DISTINCT source1_entity_id AS s1 FROM truth_pairs WHERE (source1_entity_id, candidate_entity_id) NOT IN (SELECT (source1_entity_id, candidate_entity_id) FROM tops))
SELECT 'few candidates' AS files, 'warning' AS kind, (SELECT count(*) FROM off) || ' queries have matches that are no candidates, such as ' || string_agg(s1, ',' ORDER BY s1) AS message
FROM (SELECT s1 FROM off ORDER BY s1 LIMIT 5) HAVING count(*) > 0
UNION ALL VALUES ('no candidates', 'warning', 'candidates: file not found'), ('no candidates', 'warning', 'ids are not looked up in the pool; give valid_ids for that'), ('no matches', 'error', 'matches: file not found'),
  ('other header', 'error', 'matches: unexpected header [''source1_entity_id'', ''candidate_entity_ids''], expected [''source1_entity_id'', ''matched_entity_ids'']'),
  ('commas', 'error', 'matches: the header has commas and no tab: columns must be separated by tabs'), ('empty', 'error', 'matches: the file is empty')""")
def validated_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports on several pairs of result files: true ones, and some with one fault each. A file is kept as long as it is read."""
    queries, pool = tables.part_sides(spark, sf_dir)
    ids = tables.match_targets(pool.where("entity_id like 'S2-%'"), pool.where("entity_id like 'S3-%'"))
    nothing = spark.createDataFrame([], "source1_entity_id string, ids array<string>")
    heads = {"matching": validate.MATCHING_HEADER, "candidate": validate.CANDIDATE_HEADER, "commas": (",".join(validate.MATCHING_HEADER),)}
    rows = []

    def file(lists: DataFrame, header: str) -> str:
        path = new_path(spark, "lists")
        sinks.write_lists(lists, path, heads[header], compression="gzip")
        return path

    def case(name: str, matches: str, candidates: str | None, valid: DataFrame | None, *done: str) -> None:
        report = validate.validate_files(spark, matches, candidates, queries, valid)
        said = [("error", m) for m in report.errors] + [("warning", m) for m in report.warnings]
        rows.extend((name, kind, m.replace(matches, "matches").replace(candidates or "-", "candidates")) for kind, m in said)
        remove(spark, *done)

    with shuffle_files_dropped(spark):
        truth = part_truth(spark, sf_dir)
        true, found = truth.withColumnRenamed("matched", "ids"), listed_candidates(queries, pool)
        every = labels.beside(truth, found).select("source1_entity_id", F.array_sort(F.array_union("matched", F.coalesce("ids", F.array().cast("array<string>")))).alias("ids"))
        absent, blank, good = new_path(spark, "absent"), new_path(spark, "blank"), file(true, "matching")
        nothing.select("source1_entity_id").coalesce(1).write.text(blank)
        case("all candidates", good, path := file(every, "candidate"), ids, path)
        case("few candidates", good, path := file(found.withColumn("ids", F.slice("ids", 1, 3)), "candidate"), ids, path)
        case("no candidates", good, absent, None, good)
        case("no matches", absent, None, ids)
        case("other header", path := file(true, "candidate"), None, ids, path)
        case("commas", path := file(nothing, "commas"), None, ids, path)
        case("empty", blank, None, ids, blank)
    return spark.createDataFrame(rows, "files string, kind string, message string")


#: A file with one case of each rule.
BROKEN = ("S1-0\tS2-1,S3-2", "S1-3\t", "S1-3\tS2-4", "S1-6\tS2-1,S2-1", "S1-9\tS1-0", "S1-12\tX-1", "S1-15\tS2-1,,S2-4", "S1-18\tS2-999999", "no tab here", "", "S1-999999\tS3-2")
SQL_BROKEN = f"""WITH {PARTS}, lines AS (SELECT unnest([{", ".join("'" + b.replace(chr(9), "' || chr(9) || '") + "'" for b in BROKEN)}]) AS value),
body AS (SELECT split_part(value, chr(9), 1) AS s1, CASE WHEN trim(substr(value, strpos(value, chr(9)) + 1)) = '' THEN [] ELSE string_split(substr(value, strpos(value, chr(9)) + 1), ',') END AS ids
  FROM lines WHERE contains(value, chr(9))),
i AS (SELECT DISTINCT unnest(ids) AS id FROM body),
need AS (SELECT entity_id FROM ents WHERE entity_id LIKE 'S1-%'),
v AS (SELECT 'no_tab' AS rule, value AS o FROM lines WHERE NOT contains(value, chr(9)) AND trim(value) <> ''
  UNION SELECT 'duplicate_row', s1 FROM body GROUP BY s1 HAVING count(*) > 1
  UNION SELECT 'repeated_id', s1 FROM body WHERE len(ids) <> len(list_distinct(ids))
  UNION SELECT 'self_match', id FROM i WHERE id LIKE 'S1-%'
  UNION SELECT 'wrong_prefix', id FROM i WHERE NOT (id LIKE 'S1-%' OR id LIKE 'S2-%' OR id LIKE 'S3-%')
  UNION SELECT 'unknown_id', id FROM i WHERE (id LIKE 'S2-%' OR id LIKE 'S3-%') AND id NOT IN (SELECT entity_id FROM ents)
  UNION SELECT 'missing_row', entity_id FROM need WHERE entity_id NOT IN (SELECT s1 FROM body)
  UNION SELECT 'extra_row', s1 FROM body WHERE s1 NOT IN (SELECT entity_id FROM need)),
n AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY o) AS rn FROM v)
SELECT rule, count(*) AS offenders, string_agg(o, ',' ORDER BY o) FILTER (rn <= 5) AS examples FROM n GROUP BY rule"""


@query(SQL_BROKEN)
def validate_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, pool = tables.part_sides(spark, sf_dir)
    lines = spark.createDataFrame([(x,) for x in BROKEN], "value string")
    return validate.summary(validate.violations(lines, queries, pool))


@query(f"""{SQL_CLAIMED}, tops AS (SELECT source1_entity_id, candidate_entity_id FROM cands WHERE blocking_rank <= 3)
SELECT DISTINCT source1_entity_id AS s1 FROM truth_pairs WHERE (source1_entity_id, candidate_entity_id) NOT IN (SELECT (source1_entity_id, candidate_entity_id) FROM tops)""")
def matches_outside_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, _ = tables.part_sides(spark, sf_dir)
    tops = assign.collected(part_candidates(spark, sf_dir).where("blocking_rank <= 3"), queries)
    lines = labels.beside(part_truth(spark, sf_dir), tops)
    return validate.lacking(lines.select(F.col("source1_entity_id").alias("s1"), F.col("matched").alias("_m"), F.col("ids").alias("_c")))


def _trained(mode: str, truth: Callable[[], F.Column], trees: int = 20) -> None:
    """Train and match over all parts, with few trees."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        queries, pool = tables.part_sides(spark, sf_dir)
        config = linkage.configured(mode, trees=trees, rate=0.3)
        known, members = linkage.compared(config, queries, pool)
        made, threshold, _ = linkage.trained(config, known, members, truth_of(queries, pool, truth))
        matches = linkage.decided(linkage.configured(mode, threshold=threshold), made, known, members)
        return matches.select("source1_entity_id", "candidate_entity_id", "probability")

    run.__name__ = f"link_mode_{mode.lower()}"
    query()(run)


for _mode in ("A", "B", "D"):
    _trained(_mode, name_and_brand)


@query(f"WITH {sql_tfidf(PARTS, WORD_NGRAMS, 2, blocking.VOCABULARY, 1)} SELECT source1_entity_id, candidate_entity_id, score AS probability FROM cands WHERE score >= 0.76")
def link_mode_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, matches = linkage.link(linkage.MODES["C"], *tables.part_sides(spark, sf_dir))
    return matches.select("source1_entity_id", "candidate_entity_id", "probability")
