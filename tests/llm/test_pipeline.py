"""The corpus pipeline: each stage on odd rows, and a whole run stage by stage."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing, ngram_join, packing, quality, registry, secrets


@pytest.fixture(scope="module")
def data():
    return "/root/testdata/sf0.001"


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_stage_takes_odd_and_no_rows(spark, odd, none, data, name, stage):
    got = stage(spark, odd, data)
    if name != "packing":
        assert got.columns == odd.columns
    got.collect()
    assert stage(spark, none, data).count() == 0


def test_run_is_its_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    model = quality.quality_model(spark, docs, data)
    good = quality.scored(docs, model).where(F.col("score") >= 0.3).drop("score")
    one = ngram_join.deduplicated(good)
    assert one.count() == ngram_join.near_duplicates(good).select("class_id").distinct().count()
    clean = {r["doc_id"]: r["text"] for r in secrets.redacted(one).collect()}
    assert not any(secrets.base_spans(t) for t in clean.values() if t)
    mixed = mixing.mixed_documents(secrets.redacted(one))
    want = packing.pieces(mixed).select("doc_id", "piece", "start", "length", "ids_crc32")
    got = corpus_pipeline.run(spark, data)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_labelled_good_documents_stay(spark):
    path = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    labels = spark.read.parquet(f"{path}/labels.parquet").where("quality = 1")
    kept = corpus_pipeline.keep_good(spark, docs, path).join(labels, "doc_id", "left_semi").count()
    assert kept >= 0.97 * docs.join(labels, "doc_id", "left_semi").count()


def test_every_operator_has_its_query():
    assert sorted(int(k[2:].split("_")[0]) for k in registry.QUERIES) == list(range(1, 11))
    assert set(registry.SQL) <= set(registry.QUERIES)
