import math
import os
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import features
from tessera.operators import assign, blocking, labels, metrics, model, validate
from tessera.operators.order import first_rows
from tessera.plans import linkage
from tessera.sources import sinks, tables
from tessera.streaming.candidates import stream_candidates


def entities(spark, rows):
    return spark.createDataFrame(rows, tables.ENTITY)


@pytest.fixture(scope="module")
def pool(spark):
    return entities(spark, [("S2-1", "acme foods", "main street", "US"), ("S2-2", "acme tools", "oak road", "US"), ("S3-1", "zen foods", "main street", "US"), ("S3-2", "other thing", None, "US"), ("S3-9", "acme foods", "main st", None)])


def test_index_search(spark, pool):
    queries = entities(spark, [("S1-1", "acme foods", "main st", "US"), ("S1-2", "acme foods", "main st", "FR"), ("S1-3", "acme foods", "main st", None), ("S1-4", None, "", "US")])
    got = blocking.block_topk(queries, pool)
    assert [tuple(r) for r in got.orderBy("blocking_rank").collect()] == [("S1-1", "S2-1", 4.532477, 1), ("S1-1", "S3-1", 3.021651, 2), ("S1-1", "S2-2", 1.510826, 3)]
    totals = blocking.blocking_totals(got, queries).first()
    assert tuple(totals) == (4, 3, 0.75, 3)
    tokens = blocking.entity_tokens(pool)
    sizes = blocking.country_sizes(pool)
    idf = {r["token"]: r["df"] for r in blocking.token_idf(tokens, sizes, 1).collect()}
    assert set(idf.values()) == {1} and "acme" not in idf
    assert blocking.token_idf(tokens, sizes, 2).where("token = 'acme'").first()["idf"] == pytest.approx(math.log(5 / 3) + 1)


def test_cosine_modes(spark, pool):
    queries = entities(spark, [("S1-1", "acme foods", "main street", "US"), ("S1-2", "zzz", "qqq", "US"), ("S1-3", "acme", "foods", "FR")])
    got = blocking.tfidf_topk(queries, pool, min_df=1)
    first = got.where("source1_entity_id = 'S1-1' and blocking_rank = 1").first()
    assert (first["candidate_entity_id"], first["score"]) == ("S2-1", 1.0)
    assert blocking.best_match(queries, pool, min_df=1).count() == 1
    near = blocking.charwb_knn(queries, pool, 3)
    assert {r["source1_entity_id"]: r["count"] for r in near.groupBy("source1_entity_id").count().collect()} == {"S1-1": 3, "S1-2": 3, "S1-3": 3}
    assert near.where("source1_entity_id = 'S1-2' and score > 0").count() == 0


def test_f05(spark):
    cases = [([], [], 1.0), (["x"], [], 0.0), (["a", "b"], ["a", "b"], 1.0), (["a"], ["a", "b"], 0.833333), (["c"], ["a"], 0.0), (["a", "b"], ["a"], 0.555556), (["a", "b", "c"], ["a", "b"], 0.714286), ([], ["a"], 0.0)]
    for predicted, true, value in cases:
        t = spark.createDataFrame([("S1-1", true)], "source1_entity_id string, matched array<string>")
        p = spark.createDataFrame([("S1-1", predicted)], "source1_entity_id string, predicted array<string>")
        assert metrics.macro_f05(t, p).first()[0] == value
    t = spark.createDataFrame([("a", ["S2-1"]), ("b", []), ("c", ["S2-5"])], "source1_entity_id string, matched array<string>")
    p = spark.createDataFrame([("a", ["S2-1"]), ("c", ["S2-5", "S3-9"]), ("z", ["S2-7"])], "source1_entity_id string, predicted array<string>")
    assert metrics.macro_f05(t, p).first()[0] == 0.851852


def test_assignment_is_greedy(spark):
    rng = random.Random(4)
    claims = [(f"S1-{q}", f"S2-{c}", round(rng.random(), 2)) for q in range(30) for c in range(40) if rng.random() < 0.3]
    taken, kept = set(), set()
    for q, c, p in sorted(claims, key=lambda x: (-x[2], x[0])):
        if c not in taken:
            taken.add(c)
            kept.add((q, c, p))
    table = spark.createDataFrame(claims, "source1_entity_id string, candidate_entity_id string, probability double")
    assert {tuple(r) for r in assign.assign_pool_unique(table).collect()} == kept
    lists = assign.collected(table, entities(spark, [("S1-1", "", "", "US"), ("S1-99", "", "", "US")]), "probability", False)
    got = {r["source1_entity_id"]: r["ids"] for r in lists.collect()}
    assert got["S1-99"] == [] and got["S1-1"] == [c for q, c, p in sorted(claims, key=lambda x: (-x[2], x[1])) if q == "S1-1"]


def test_threshold_search_equals_one_by_one(spark):
    rng = random.Random(5)
    claims = spark.createDataFrame([(f"S1-{q}", f"S2-{q * 3 + c}", round(rng.random(), 2)) for q in range(25) for c in range(3)], "source1_entity_id string, candidate_entity_id string, probability double")
    truth = spark.createDataFrame([(f"S1-{q}", [f"S2-{q * 3 + c}" for c in range(q % 3)]) for q in range(28)], "source1_entity_id string, matched array<string>")
    got = {r["threshold"]: r["macro_f05"] for r in metrics.threshold_search(claims, truth).collect()}
    assert len(got) == 47
    for t in (0.5, 0.77, 0.96):
        assert got[t] == pytest.approx(metrics.macro_f05(truth, metrics.predictions(claims, t)).first()[0], abs=5.1e-5)
    assert tables.best_threshold(metrics.threshold_search(claims, truth)) == min(t for t, v in got.items() if v == max(got.values()))
    assert tables.best_threshold(spark.createDataFrame([], "threshold double, macro_f05 double")) == 0.88


def test_labels_and_splits(spark):
    pairs = spark.createDataFrame([("S1-1", f"S2-{i}", i) for i in range(1, 12)], "source1_entity_id string, candidate_entity_id string, blocking_rank int")
    truth = spark.createDataFrame([("S1-1", ["S2-11", "S2-50"])], "source1_entity_id string, matched array<string>")
    got = labels.hard_negatives(labels.labelled(pairs, truth))
    assert sorted(r["blocking_rank"] for r in got.collect()) == [1, 2, 3, 4, 5, 11]
    assert labels.with_true_pairs(pairs, truth).count() == 12
    rows = entities(spark, [(f"S1-{i}", "", "", "US") for i in range(1000)])
    one, two = labels.split(rows)
    assert abs(one.count() - 800) < 50 and one.join(two, "entity_id").count() == 0 and one.count() + two.count() == 1000
    assert labels.sample(rows, 10).count() == 10


def test_features_of_empty_sides(spark, pool):
    pairs = spark.createDataFrame([("S1-1", "S3-2", 1), ("S1-1", "S2-404", 2)], "source1_entity_id string, candidate_entity_id string, blocking_rank int")
    got = features.with_sides(pairs, entities(spark, [("S1-1", "Other Thing", None, "US")]), pool)
    a = {r["candidate_entity_id"]: r for r in features.mode_a(got).collect()}
    assert a["S3-2"]["name_token_sort_ratio"] == 100 and a["S3-2"]["address_levenshtein"] == 100 and a["S3-2"]["addr_token_overlap"] == 1 and a["S3-2"]["number_overlap"] == -1
    assert a["S2-404"]["name_wratio"] == 0
    b = {r["candidate_entity_id"]: r for r in features.mode_b(got).collect()}
    assert b["S3-2"]["addr_ratio"] == 0 and b["S3-2"]["digits_jaccard"] == 1 and b["S3-2"]["first_digit_match"] == 0 and b["S2-404"]["is_source2"] == 1
    assert set(features.MODE_D) < set(features.mode_d(got).columns)


def test_queries_share_the_lists_of_truth(spark):
    from tessera.plans.queries import name_and_brand, truth_of

    pool = entities(spark, [(f"S2-{i}", "acme", "x 1", "US") for i in range(40)] + [("S3-1", "zen", "y", "US"), ("S3-2", "zen", "y", None)])
    queries = entities(spark, [(f"S1-{i}", "acme", f"x {i}", "US") for i in range(30)] + [("S1-90", "zen", "y", "US"), ("S1-91", "lone", "z", "US"), ("S1-92", None, None, "US")])
    truth = truth_of(queries, pool, name_and_brand)
    plain = truth.select("*")
    of, lists = truth._lists
    assert (of.count(), lists.count(), sum(len(r["matched"]) for r in lists.collect())) == (33, 3, 42)
    rows = [(f"S1-{q}", f"S2-{c}", c / 50) for q in (1, 2, 90, 91, 92, 404) for c in range(0, 45, 4)] + [("S1-90", "S3-1", 0.9), ("S1-91", "S3-1", 0.8)]
    claims = spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_id string, probability double")
    same = lambda f: (sorted(map(tuple, f(truth).collect())), sorted(map(tuple, f(plain).collect())))
    for f in (
        lambda t: labels.labelled(claims, t), lambda t: metrics.threshold_search(claims, t, assign=True), lambda t: metrics.macro_f05(t, metrics.predictions(claims, 0.6)),
        lambda t: validate.lacking(labels.beside(t, metrics.predictions(claims, 0.2)).selectExpr("source1_entity_id AS s1", "matched AS _m", "predicted AS _c")),
    ):
        one, other = same(f)
        assert one == other and one
    assert labels.labelled(claims, truth).where("label = 1").count() == 21


def test_search_gives_the_sides(spark):
    """As with_sides gives them, of ids on several rows, of queries that share their words, and of null values."""
    pool = entities(spark, [("S2-1", "acme foods", "main street", "US"), ("S2-2", "Foods Acme", "main street", "US"), ("S2-3", "acme", None, "US"), ("S2-3", "acme tools", "x", "US"), ("S3-1", "zen foods", None, "US")])
    queries = entities(spark, [("S1-1", "acme foods", "main st", "US"), ("S1-2", "Foods, Acme", "main st", "US"), ("S1-3", "acme", None, "US"), ("S1-4", "zen", "a", "US"), ("S1-4", "foods", None, "US"), ("S1-5", None, None, "US")])
    sides = blocking.block_topk(queries, pool, sides=(queries, pool))
    expected = features.with_sides(blocking.block_topk(queries, pool), queries, pool)
    assert sides.columns == expected.columns
    assert sorted(map(tuple, sides.collect())) == sorted(map(tuple, expected.collect())) and sides.count() > 12


def test_one_query_stands_for_its_text(spark):
    rows = [("S1-1", "acme", None, "US"), ("S1-2", "acme", None, "US"), ("S1-3", "acme", "", "US"), ("S1-4", "acme", None, None), ("S1-5", "acme", None, None), ("S1-6", "acme", None, "US"), ("S1-6", "zen", None, "US"), ("S1-7", "zen", None, "US")]
    few, members = tables.one_of_each_text(entities(spark, rows))
    stand = {"S1-1": "S1-1", "S1-2": "S1-1", "S1-3": "S1-3", "S1-4": "S1-4", "S1-5": "S1-4", "S1-6": "S1-6", "S1-7": "S1-7"}
    assert sorted(map(tuple, members.collect())) == sorted(stand.items())
    assert sorted(map(str, map(tuple, few.collect()))) == sorted(str(r) for r in rows if r[0] in stand.values())


def test_sides_keep_the_order_of_columns(spark, pool):
    pairs = spark.createDataFrame([("S1-1", "S3-2", 1)], "source1_entity_id string, candidate_entity_id string, blocking_rank int")
    for inner in (False, True):
        got = features.with_sides(pairs, pool, pool, inner)
        assert got.columns == [*pairs.columns, "s1_name", "s1_address", "c_name", "c_address"]
        assert features.mode_b(got).columns == [*pairs.columns, *features.MODE_B]


def test_contract_rules(spark, tmp_path):
    source1 = entities(spark, [(f"S1-{i}", "", "", "US") for i in range(8)])
    valid = entities(spark, [("S2-1", "", "", "US"), ("S3-2", "", "", "US")])
    body = ["S1-0\tS2-1,S3-2", "S1-1\t", "S1-1\tS2-1", "S1-2\tS2-1,S2-1", "S1-3\tS1-9", "S1-4\tX-1", "S1-5\tS2-1,,S3-2", "S1-6\tS2-404", "no tab", "", "S1-77\tS3-2"]
    lines = spark.createDataFrame([(x,) for x in body], "value string")
    got = {(r["rule"], r["offender"]) for r in validate.violations(lines, source1, valid).collect()}
    assert got == {("no_tab", "no tab"), ("duplicate_row", "S1-1"), ("repeated_id", "S1-2"), ("self_match", "S1-9"), ("wrong_prefix", "X-1"), ("wrong_prefix", ""), ("unknown_id", "S2-404"), ("missing_row", "S1-7"), ("extra_row", "S1-77")}
    assert "unknown_id" not in {r["rule"] for r in validate.violations(lines, source1).collect()}
    assert validate.header_problem("a,b", validate.MATCHING_HEADER).startswith("the header has commas")
    assert validate.header_problem(" Source1_entity_id\tMATCHED_entity_ids ", validate.MATCHING_HEADER) is None
    assert validate.header_problem("x\ty", validate.MATCHING_HEADER) and validate.header_problem(None, validate.MATCHING_HEADER)
    matches = assign.collected(spark.createDataFrame([("S1-0", "S2-1"), ("S1-2", "S3-2")], "source1_entity_id string, candidate_entity_id string"), source1)
    one, two = str(tmp_path / "m"), str(tmp_path / "c")
    sinks.write_lists(matches, one, validate.MATCHING_HEADER, one_file=True)
    sinks.write_lists(assign.collected(spark.createDataFrame([("S1-0", "S2-1")], "source1_entity_id string, candidate_entity_id string"), source1), two, validate.CANDIDATE_HEADER)
    report = validate.validate_files(spark, one, two, source1, valid)
    assert report.exit_code == 0 and len(report.warnings) == 1
    assert spark.read.text(one).count() == 9 and "S1-1\t" in [r[0] for r in spark.read.text(one).collect()]
    assert validate.validate_files(spark, two, str(tmp_path / "no"), source1, valid).exit_code == 1
    sinks.zip_results({"matching_results.tsv": one}, str(tmp_path / "out.zip"))
    assert os.path.getsize(tmp_path / "out.zip") > 0
    with pytest.raises(FileNotFoundError):
        sinks.zip_results({"x": str(tmp_path)}, str(tmp_path / "bad.zip"))


def test_tables(spark, tmp_path):
    folder = tmp_path / "train"
    folder.mkdir()
    for i in (1, 2, 3):
        (folder / f"train_source{i}.tsv").write_text(f'entity_id\tbusiness_name\tbusiness_address\tcountry\nS{i}-1\tA, "B"\t\tUS\nS{i}-2\tNA\tx\tFR\n\nS{i}-3\t"q ""z"""\ty\t\n')
    (folder / "train_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1, S3-1,S2-1\nS1-2\t\nS1-3\tnan\n")
    got = tables.read_split(spark, str(folder))
    rows = {r["entity_id"]: r for r in got["source1"].collect()}
    assert rows["S1-2"]["business_name"] == "NA" and rows["S1-1"]["business_address"] is None and rows["S1-3"]["business_name"] == 'q "z"'
    assert tables.read_entities(spark, str(folder / "train_source1.tsv"), missing_words=True).where("business_name is null").count() == 1
    assert {r[0]: r[1] for r in got["ground_truth"].collect()} == {"S1-1": ["S2-1", "S3-1"], "S1-2": [], "S1-3": []}
    assert [r[0] for r in tables.available_countries(got["source1"]).collect()] == ["FR", "US"]
    assert {r[0] for r in tables.read_ids(spark, str(folder / "train_source1.tsv")).collect()} == {"S1-1", "S1-2", "S1-3"}
    assert tables.match_targets(got["source2"], got["source3"]).count() == 6 and tables.match_targets(None, got["source3"]) is None
    assert [r[0] for r in tables.head(got["source1"], 2).select("entity_id").collect()] == ["S1-1", "S1-2"]
    staged = tables.stage_by_country(got["source1"].where("country is not null"), str(tmp_path / "staged"))
    assert staged.where("country = 'FR'").count() == 1
    assert tables.first_of_each(tables.pool(got["source2"], got["source2"])).count() == 3


def test_train_save_and_link(spark, small, tmp_path):
    queries, pool = tables.part_sides(spark, small)
    from tessera.plans.queries import name_and_brand, truth_of

    config = linkage.configured("A", trees=4, rate=0.3)
    truth = truth_of(queries, pool, name_and_brand)
    pairs = linkage.candidates(config, queries, pool)
    made = model.train(linkage.pair_features(config, labels.labelled(pairs, truth), queries, pool), "A", 4, 0.3)
    model.save(made, 0.7, str(tmp_path / "model"), spark)
    again, threshold, names = model.load(str(tmp_path / "model"), spark)
    assert threshold == 0.7 and tuple(names) == features.MODE_A and model.importances(again)[0][1] >= 0
    counts = [linkage.link(linkage.configured("A", threshold=t), queries, pool, again)[1].count() for t in (0.0, 0.3, 0.9)]
    assert counts == sorted(counts, reverse=True) and counts[0] > 0
    with pytest.raises(ValueError, match="features are missing"):
        model.scored(again, pairs)
    with pytest.raises(ValueError, match="needs a model"):
        linkage.link(config, queries, pool)


def test_stream(spark, pool, tmp_path):
    new = entities(spark, [("S1-1", "acme foods", "main st", "US")])
    new.write.parquet(str(tmp_path / "in"))
    stream_candidates(pool, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).drop("batch").count() == blocking.block_topk(new, pool).count() == 3


def test_recall_and_audit(spark):
    truth = spark.createDataFrame([("a", ["S2-1", "S2-2"]), ("b", []), ("c", ["S2-5"])], "source1_entity_id string, matched array<string>")
    cands = spark.createDataFrame([("a", "S2-1"), ("a", "S2-9"), ("c", "S2-5")], "source1_entity_id string, candidate_entity_id string")
    assert tuple(blocking.candidate_recall(cands, truth).first()) == (0.666667, 3, 2, 1.0)
    predicted = spark.createDataFrame([("a", ["S2-1"]), ("b", ["S2-3"])], "source1_entity_id string, predicted array<string>")
    got = metrics.audit_summary(truth, cands, predicted).first().asDict()
    assert got == {"blocking_recall": 66.666667, "classifier_retention": 50.0, "micro_precision": 50.0, "micro_recall": 33.333333, "macro_precision": 100.0, "macro_recall": 25.0, "singleton_accuracy": 0.0, "macro_f05": 0.277778}
    empty = truth.where(F.lit(False))
    assert metrics.audit_summary(empty, cands, predicted).first()["singleton_accuracy"] == 100.0


def test_hot_tokens_are_dealt_out(spark, small, monkeypatch):
    queries, pool = tables.part_sides(spark, small)
    rows = lambda df: sorted(map(tuple, df.collect()))
    expected = rows(blocking.block_topk(queries, pool)), rows(blocking.tfidf_topk(queries, pool))
    monkeypatch.setattr(blocking, "PAIRS", 50)
    assert (rows(blocking.block_topk(queries, pool)), rows(blocking.tfidf_topk(queries, pool))) == expected


def test_blocking_fills_all_partitions(spark, small):
    got = blocking.block_topk(*tables.part_sides(spark, small))
    held = got.select(F.spark_partition_id().alias("p")).distinct().count()
    assert held > 1


def test_a_small_vocabulary(spark, small):
    queries, pool = tables.part_sides(spark, small)
    some, _ = blocking.tfidf_vectors(pool, queries, blocking.tfidf_text(), lambda c: F.split(c, " "), 1, 3)
    counts = {}
    for r in pool.select("country", F.explode(F.split(blocking.tfidf_text(), " ")).alias("t")).collect():
        counts.setdefault(r["country"], {}).setdefault(r["t"], []).append(1)
    for country, terms in counts.items():
        best = sorted(terms, key=lambda t: (-len(terms[t]), t))[:3]
        assert {r[0] for r in some.where(F.col("country") == country).select("token").distinct().collect()} == set(best)


def test_first_rows(spark):
    rng = random.Random(9)
    rows = [(rng.choice("ab"), rng.randint(0, 30), i) for i in range(500)]
    table = spark.createDataFrame(rows, "k string, v int, i int")
    for n in (1, 40, 400):
        got = first_rows(table, ["k"], F.floor(F.col("v") / 4), [F.col("v"), F.col("i")], n).collect()
        assert sorted(map(tuple, got)) == sorted(r for k in "ab" for r in sorted((x for x in rows if x[0] == k), key=lambda r: r[1:])[:n])


def test_rows_of_one_id(spark):
    queries = entities(spark, [("S1-1", "b", "x", "US"), ("S1-1", "a", "x", "US")])
    pool = entities(spark, [("S2-1", "zz", None, "US"), ("S2-1", "b", None, "US")])
    pairs = spark.createDataFrame([("S1-1", "S2-1", 1), ("S1-1", "S2-9", 2)], "source1_entity_id string, candidate_entity_id string, blocking_rank int")
    got = {m: linkage.pair_features(linkage.MODES[m], pairs, queries, pool).collect() for m in ("A", "B")}
    assert [r["name_token_sort_ratio"] for r in sorted(got["A"], key=lambda r: r["candidate_entity_id"])] == [0.0, 0.0]  # a with b, a with nothing
    assert [r["candidate_entity_id"] for r in got["B"]] == ["S2-1"]


def test_a_search_without_pairs(spark):
    claims = spark.createDataFrame([], "source1_entity_id string, candidate_entity_id string, probability double")
    truth = spark.createDataFrame([("S1-1", ["S2-1"])], "source1_entity_id string, matched array<string>")
    threshold, search = linkage.searched(linkage.MODES["B"], claims, truth)
    assert threshold == 0.85 and [tuple(r) for r in search.collect()] == [(0.85, 0.0)]


def test_lines_in_order(spark, tmp_path):
    source1 = entities(spark, [("S1-1", "", "", "US"), ("S1-2", "", "", "US")])
    matches, candidates = str(tmp_path / "m"), str(tmp_path / "c")
    head = "\t".join(validate.MATCHING_HEADER)
    (tmp_path / "m").write_bytes(f"{head}\nS1-1\tS2-9\nS1-1\tS2-1\n{head}\nS1-2\t".encode() + b"\xff\n")
    (tmp_path / "c").write_text("\t".join(validate.CANDIDATE_HEADER) + "\nS1-1\tS2-1\nS1-2\t\n")
    report = validate.validate_files(spark, matches, candidates, source1)
    text = " ".join(report.errors)
    assert "extra_row: 1 in all, such as source1_entity_id" in text and "duplicate_row" in text and "not_utf8" in text
    (tmp_path / "m").write_text(f"{head}\nS1-1\tS2-9\nS1-1\tS2-1\nS1-2\t\n")
    body = validate.parsed(validate._body(spark, matches, validate.MATCHING_HEADER)[1])
    cands = validate.parsed(validate._body(spark, candidates, validate.CANDIDATE_HEADER)[1])
    assert validate.outside_candidates(body, cands).count() == 0  # the last line of a query counts
    assert validate.outside_candidates(cands.withColumn("ids", F.array(F.lit("S2-7"))), body).count() == 2


def test_many_offenders(spark, monkeypatch):
    monkeypatch.setattr(validate, "PARTS", 4)
    found = spark.createDataFrame([("a", f"x{i:03}") for i in range(100)] + [("b", "y")], "rule string, offender string")
    assert sorted(map(tuple, validate.summary(found).collect())) == [("a", 100, "x000,x001,x002,x003,x004"), ("b", 1, "y")]


def test_missing_words_by_mode(spark, tmp_path):
    from tessera.__main__ import sides

    folder = tmp_path / "test"
    folder.mkdir()
    for i in (1, 2, 3):
        (folder / f"test_source{i}.tsv").write_text(f"entity_id\tbusiness_name\tbusiness_address\tcountry\nS{i}-1\tNA\tnan\tUS\n")
    assert sides(spark, str(folder), "A")[0].first()["business_name"] is None and sides(spark, str(folder), "B")[0].first()["business_name"] == "NA"


def test_feature_tables(spark, tmp_path):
    spark.createDataFrame([(1.0, 2.0)], "a double, b double").write.parquet(str(tmp_path / "f"))
    assert tables.read_features(spark, str(tmp_path / "f"), ("a", "b")).count() == 1
    with pytest.raises(ValueError, match="features are missing: c"):
        tables.read_features(spark, str(tmp_path / "f"), ("a", "c"))
    assert {r[0] for r in tables.read_truth(spark, _truth_file(tmp_path), trim=False).select(F.explode("matched")).collect()} == {"S2-1", " S3-1"}


def _truth_file(folder):
    (folder / "t").write_text("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1, S3-1\n")
    return str(folder / "t")


def test_copies_are_compared_once(spark, small, monkeypatch):
    """Copies of a table make candidates for each row, as SQL says, but no pairs of their own; an id on several rows has the tokens of all."""
    import duckdb

    from tessera.plans.queries import SQL

    ents = tables.part_entities(spark, small)
    copies = ents.crossJoin(spark.range(4)).select(F.concat(F.left("entity_id", F.lit(3)), F.lit("9"), "id", F.lit("0000"), F.substring("entity_id", 4, 9)).alias("entity_id"), "business_name", "business_address", "country")
    again = ents.where("entity_id in ('S1-0', 'S2-1', 'S3-2')").withColumn("business_address", F.lit("Brand#7 12 red gear"))
    once, duck = ents.union(copies).toPandas(), duckdb.connect()
    twice = ents.union(copies).union(again).toPandas()
    summed, made = blocking.summed, []
    monkeypatch.setattr(blocking, "summed", lambda *a: made.append(summed(*a)) or made[-1])
    for name, run, table in (("block_topk_parts", blocking.block_topk, twice), ("tfidf_word_topk", blocking.tfidf_topk, twice), ("charwb_knn", blocking.charwb_knn, once)):  # the last one's SQL pairs rows, not ids
        duck.register("given", table)
        queries, pool = (spark.createDataFrame(table).where(c) for c in ("entity_id like 'S1-%'", "entity_id not like 'S1-%'"))
        sql = SQL[name]
        at = sql.index("AS (SELECT 'S'") + 4
        expected = duck.sql(sql[:at] + "SELECT * FROM given" + sql[sql.index(" FROM part)", at) + len(" FROM part") :]).fetchall()
        assert {tuple(r) for r in run(queries, pool).collect()} == {(q, c, s, r) for q, c, s, r in expected}, name
    rows = made[0].select(F.countDistinct("source1_entity_id"), F.countDistinct("candidate_entity_id")).first()
    assert rows[0] <= ents.where("entity_id like 'S1-%'").count() + 1 and rows[1] <= ents.where("entity_id not like 'S1-%'").count() + 2  # and the repeated ids


def test_sums_do_not_depend_on_order(spark):
    """0.1, 0.2 and others sum to the same in any order, and halves go up."""
    values = [1.100000001, 2.2000003, 3.3000001, 4.440000001, 0.000000098]
    rows = [(q, "US", f"t{i}", v) for q in ("S1-1", "S1-2") for i, v in (enumerate(values) if q == "S1-1" else reversed(list(enumerate(values))))]
    asked = spark.createDataFrame(rows, "source1_entity_id string, country string, token string, idf double")
    held = spark.createDataFrame([("S2-1", "US", f"t{i}") for i in range(5)], "candidate_entity_id string, country string, token string")
    assert {r["score"] for r in blocking.summed(asked, held).collect()} == {11.040001}  # 11.0400005


def test_sums_are_those_of_doubles(spark):
    """A sum that is a half in decimals, yet less as doubles are, goes down as in SQL, in any order."""
    values = [3.868173791, 2.994723218, 3.068054491, 1.0]
    rows = [(q, "US", f"t{i}", v) for q in ("S1-1", "S1-2") for i, v in (enumerate(values) if q == "S1-1" else reversed(list(enumerate(values))))]
    asked = spark.createDataFrame(rows, "source1_entity_id string, country string, token string, idf double")
    held = spark.createDataFrame([("S2-1", "US", f"t{i}") for i in range(4)], "candidate_entity_id string, country string, token string")
    assert {r["score"] for r in blocking.summed(asked, held).collect()} == {10.930951}
    most = spark.createDataFrame([("S1-1", "US", f"t{i}", 31.9) for i in range(500)], "source1_entity_id string, country string, token string, idf double")
    held = spark.createDataFrame([("S2-1", "US", f"t{i}") for i in range(500)], "candidate_entity_id string, country string, token string")
    assert [r["score"] for r in blocking.summed(most, held, 500).collect()] == [15950.0]


def test_candidates_are_made_once(spark, small, monkeypatch):
    from tessera.plans import queries

    find, made = queries.part_candidates, []
    monkeypatch.setattr(queries, "part_candidates", lambda *a: made.append(a) or find(*a))
    assert queries.audit_summary(spark, small).count() == 1 and len(made) == 1


def test_pairs_are_not_shuffled(spark, small, monkeypatch):
    """Also where no side of the join of tokens is small enough for a broadcast."""
    keep, plans = blocking.stored, []
    monkeypatch.setattr(blocking, "stored", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or keep(df, name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert blocking.block_topk(*tables.part_sides(spark, small)).count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = dict(plans)["near"]
    exchanges = [x for x in plan.splitlines() if "Exchange" in x and "source1_entity_id" in x and "candidate_entity_id" in x]
    assert "SortMergeJoin" in plan and not exchanges
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_training_compares_one_query_of_each_text(spark, small, monkeypatch):
    """Examples by their weights, claims and matches are those of all queries, though candidates and features are made once for each text."""
    from tessera.plans.queries import name_and_brand, truth_of

    ents = tables.part_entities(spark, small).orderBy("entity_id").limit(60)  # of S1
    copies = ents.crossJoin(spark.range(1, 6)).select(F.concat(F.lit("S"), F.col("id") % 3 + 1, F.lit("-9"), "id", F.lit("0000"), F.substring("entity_id", 4, 9)).alias("entity_id"), "business_name", "business_address", "country")
    rows = spark.createDataFrame(ents.union(copies).toPandas())
    queries, pool = rows.where("entity_id like 'S1-%'"), rows.where("entity_id not like 'S1-%'")
    truth, config = truth_of(queries, pool, name_and_brand), linkage.configured("A", k=10, trees=2, rate=0.3)
    find, fit, search, made, given = linkage.candidates, model.train, linkage.searched, [], {}
    monkeypatch.setattr(linkage, "candidates", lambda *a: made.append(find(*a)) or made[-1])
    monkeypatch.setattr(model, "train", lambda pairs, *a: given.update(examples=pairs) or fit(pairs, *a))
    monkeypatch.setattr(linkage, "searched", lambda config, claims, judged: given.update(claims=claims, judged=judged) or search(config, claims, judged))
    known, members = linkage.compared(config, queries, pool)
    fitted, threshold, _ = linkage.trained(config, known, members, truth)
    assert len(made) == 1 and made[0].select("source1_entity_id").distinct().count() * 2 == find(config, queries, pool).select("source1_entity_id").distinct().count()
    few, all_ = linkage.labels.split(labels.labelled(find(config, queries, pool), truth), 0.75, "source1_entity_id")
    weights = {r["label"]: r["n"] for r in given["examples"].groupBy("label").agg(F.sum("weight").alias("n")).collect()}
    assert weights == {r["label"]: r["count"] for r in labels.hard_negatives(few).groupBy("label").count().collect()} and len(weights) == 2
    got = lambda df: sorted(map(tuple, df.select("source1_entity_id", "candidate_entity_id", "probability").collect()))
    claims = model.scored(fitted, linkage.pair_features(config, all_, queries, pool))
    assert got(assign.assign_pool_unique(given["claims"])) == got(assign.assign_pool_unique(claims))
    assert sorted(map(tuple, given["judged"].collect())) == sorted(map(tuple, truth.where(~labels.in_share("source1_entity_id", 0.75)).collect()))
    for unique in (True, False):
        setting = linkage.configured("A", k=10, threshold=threshold, pool_unique=unique)
        matches = got(linkage.decided(setting, fitted, known, members))
        assert matches == got(linkage.link(setting, queries, pool, fitted)[1]) and matches
    linkage.trained(linkage.configured("A", k=10, trees=1, pool_unique=False), known, members, truth)
    assert [(q, c) for q, c, _ in got(given["claims"])] == [(q, c) for q, c, _ in got(claims)]


def test_a_leaf_is_limited_by_weight(spark):
    """Examples that stand for many make leaves that as many rows would."""
    rows = [(float(i >= 10), i >= 10, w) for w in (1.0, 30.0) for i in range(20)]
    pairs = spark.createDataFrame(rows, "x double, y boolean, weight double").select(F.col("y").cast("int").alias("label"), "weight", *[F.col("x").alias(n) for n in features.MODE_A])
    sizes = [model.train(pairs.where(F.col("weight") == w), "A", 1, 0.3, "weight").stages[1].trees[0].numNodes for w in (1.0, 30.0)]
    assert sizes[0] == 1 and sizes[1] > 1


def test_large_files_are_validated_in_passes(spark, tmp_path, monkeypatch):
    """With compressed lists, few known ids sent or none, and queries in one share or several: the same report; what is dropped is read no more."""
    from tessera.sources.shared import shuffle_files_dropped

    source1 = entities(spark, [(f"S1-{i}", "", "", "US") for i in range(30)])
    valid = spark.createDataFrame([(f"S2-{i}",) for i in range(20)], "entity_id string")
    lists = spark.createDataFrame([(f"S1-{i}", [f"S2-{i}", f"S2-{i + 1}"] if i % 3 else ["S2-1", "S2-1", "X-1", "S1-2", ""]) for i in range(1, 32)], "source1_entity_id string, ids array<string>")
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    sinks.write_lists(lists, one, validate.MATCHING_HEADER, compression="gzip")
    sinks.write_lists(lists.withColumn("ids", F.slice("ids", 1, 1)), two, validate.CANDIDATE_HEADER, compression="gzip")
    assert any(f.endswith(".gz") for f in os.listdir(one))
    whole = validate.validate_files(spark, one, two, source1, valid)
    monkeypatch.setattr(validate, "TOGETHER", 64)
    monkeypatch.setattr(validate, "KNOWN", 0)
    made, keep = [], validate.stored
    monkeypatch.setattr(validate, "stored", lambda df, name: made.append(name) or keep(df, name))
    with shuffle_files_dropped(spark):
        again = validate.validate_files(spark, one, two, source1, valid)
    assert (again.errors, again.warnings) == (whole.errors, whole.warnings)
    assert made.count("outside") > 1 and made.count("lines") == 2
    rules = {e.split(": ")[1] for e in whole.errors}
    assert rules == {"extra_row", "missing_row", "repeated_id", "self_match", "unknown_id", "wrong_prefix"}
