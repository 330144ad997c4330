import itertools
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import similarity as sim
from tessera.functions import text


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.select("i", f("x").alias("y")).orderBy("i").select("y").collect()]


def test_cleaning(spark):
    names = ["Acme Private Limited, Inc.", "ACME Pvt. Ltd.", "Café & Co.", "The Company Store", None, "", "a b"]
    assert column(spark, names, text.clean_canonical) == ["acme pvt ltd inc", "acme pvt ltd", "caf co", "the co store", "", "", "a b"]
    assert column(spark, names, text.clean_expanded) == ["acme private limited incorporated", "acme private limited", "caf company", "the company store", "", "", "a b"]
    assert column(spark, names, text.clean_name) == ["acme", "acme", "cafe", "the store", "", "", "a b"]


def test_addresses(spark):
    rows = ["12 Main St., Apt #4", "5 Rue de l’École, Bldg B", "10-B, M.G. Rd", None]
    assert column(spark, rows, text.clean_address) == ["12 main street apartment 4", "5 rue de l ecole building b", "10 b m g road", ""]
    assert column(spark, [*rows, "प्लॉट १२, 45"], text.digits) == [["12", "4"], ["5"], ["10"], [], ["१२", "45"]]


def test_folding_and_trimming(spark):
    assert column(spark, ["é①ﬁ", "plain", None], text.strip_accents) == ["e1fi", "plain", ""]
    assert column(spark, ["  A b\t", None], text.feature_text) == ["a b", ""]
    assert column(spark, [" us ", None], text.country_or_unknown) == ["US", "UNKNOWN"]


def test_grams(spark):
    assert column(spark, ["ab cd", "ab", "", None], text.char_ngrams) == [["abc", "bcd"], ["ab"], [], []]
    assert column(spark, ["One two x three", "one", ""], text.word_ngrams) == [["one", "two", "three", "one two", "two three"], ["one"], []]
    assert column(spark, ["a bb c dd"], text.tokens) == [["bb", "dd"]]
    assert column(spark, ["ab", ""], text.char_wb_ngrams) == [[" ab", "ab ", " ab "], []]
    assert column(spark, ["acme foods", ""], text.block_key) == ["nt1:acme", None]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = list(itertools.accumulate(range(1, len(b) + 1), lambda left, j, row=row, x=x: row[j - 1] + 1 if x == b[j - 1] else max(row[j], left), initial=0))
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abcd", max_size=30), st.text("abcd", max_size=30))
def test_lcs(a, b):
    assert sim.lcs(a, b) == lcs(a, b)


@settings(max_examples=200, deadline=None)
@given(st.text("ab ", max_size=14), st.text("ab ", max_size=14))
def test_similarities_are_percentages(a, b):
    for name, kernel in sim.KERNELS.items():
        assert 0 <= kernel(a, b) <= (1 if name == "jaro_winkler" else 100), name
        assert kernel(a, b) == pytest.approx(kernel(b, a)) or name in ("wratio", "jaro_winkler", "partial_ratio")


def test_similarity_values(spark):
    golden = [("acme foods", "foods acme", 50.0, 100.0), ("acme food", "acme foods", 94.736842, 94.736842), ("abc", "xyz", 0.0, 0.0)]
    for a, b, plain, by_token in golden:
        assert (round(sim.ratio(a, b), 6), round(sim.token_sort_ratio(a, b), 6)) == (plain, by_token)
    assert round(sim.jaro_winkler("martha", "marhta"), 6) == 0.961111 and sim.jaro_winkler("abcd", "axyz") == 0.5
    assert sim.token_set_ratio("acme foods", "acme foods ltd") == 100 and sim.token_set_ratio("", "a") == 0
    assert sim.partial_ratio("foods", "acme foods ltd") == 100 and sim.wratio("", "a") == 0
    rows = spark.createDataFrame([(None, "a"), ("", ""), ("ab", "ab")], "a string, b string")
    got = rows.select(sim.column_of("ratio")(F.col("a"), F.col("b")).alias("r"), sim.levenshtein_percent(F.coalesce("a", F.lit("")), F.coalesce("b", F.lit(""))).alias("l")).collect()
    assert [tuple(r) for r in got] == [(0.0, 0.0), (100.0, 100.0), (100.0, 100.0)]
    with pytest.raises(ValueError, match="no similarity"):
        sim.column_of("nothing")


def test_numbers(spark):
    golden = [("12 main st 560001", "12 main street 560001", 1.0, 0.0), ("12 main st", "14 main st", 0.0, 1.0), ("main", "road", -1.0, 0.0), ("12 main", "main", 0.0, 0.0), ("12 a 560001", "14 b 560001", 0.333333, 0.0)]
    rows = spark.createDataFrame([(i, *g[:2]) for i, g in enumerate(golden)], "i int, a string, b string")
    a, b = F.array_distinct(text.digits("a")), F.array_distinct(text.digits("b"))
    got = rows.orderBy("i").select(F.round(sim.number_overlap(a, b), 6), sim.veto(a, b)).collect()
    assert [tuple(r) for r in got] == [g[2:] for g in golden]
    houses = [(["12"], ["14"], 1), (["12", "7"], ["7", "9"], 0), (["12"], [], 0), (["12"], ["12"], 0), (["12", "560001"], ["14", "560001"], 1)]
    rows = spark.createDataFrame([(i, *h[:2]) for i, h in enumerate(houses)], "i int, a array<string>, b array<string>").orderBy("i")
    assert [r[0] for r in rows.select(sim.house_conflict(F.col("a"), F.col("b"))).collect()] == [h[2] for h in houses]
    assert [r[0] for r in rows.select(sim.first_digit_match(F.col("a"), F.col("b"))).collect()] == [0, 0, 0, 1, 0]


def test_random_levenshtein_is_symmetric(spark):
    rng = random.Random(0)
    pairs = [("".join(rng.choice("ab") for _ in range(rng.randint(0, 6))), "".join(rng.choice("ab") for _ in range(rng.randint(0, 6)))) for _ in range(50)]
    got = spark.createDataFrame(pairs, "a string, b string").select(sim.levenshtein_percent(F.col("a"), F.col("b")) == sim.levenshtein_percent(F.col("b"), F.col("a"))).collect()
    assert all(r[0] for r in got)


def test_canonical_tokens(spark):
    rows = ["Acme Private Limited, Inc.", "Company company co x", "Café & Co.", None, "", "  a\u2003bb\u00a0cc\n"]
    table = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string").orderBy("i")
    for got, plain in table.select(text.canonical_tokens("x"), text.tokens(text.clean_canonical("x"))).collect():
        assert got == plain


def test_repeated_tokens_are_also_compared_once():
    assert round(sim.wratio("bc bc bc ab", "bcdb ccda cdcd caa acdd baab abac"), 1) == 85.5
    assert sim.partial_token_ratio("ab ab", "cd ab") == 100


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=12), st.text("abc", max_size=20))
def test_partial_ratio_looks_at_all_pieces(a, b):
    x, y = sorted((a, b), key=len)
    pieces = lambda p, q: [q[max(0, i) : i + len(p)] for i in range(1 - len(p), len(q))]
    best = max([sim.ratio(x, q) for q in pieces(x, y)] + ([sim.ratio(y, q) for q in pieces(y, x)] if len(x) == len(y) else []), default=0.0) if x else (0.0 if y else 100.0)
    assert sim.partial_ratio(a, b) == pytest.approx(best)
