"""Every registered linkage query against its SQL on the smallest tables."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def duck(small):
    made = duckdb.connect()
    for name in os.listdir(small):
        made.execute(f"create view {name.split('.')[0]} as select * from read_parquet('{small}/{name}')")
    return made


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, small, name):
    got = entry.queries()[name](spark, small)
    expected = duck.sql(entry.oracle_sql()[name])
    columns = sorted(expected.columns)
    assert sorted(got.columns) == columns
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=key) == sorted(expected.project(", ".join(columns)).fetchall(), key=key)


def test_only_trained_modes_have_no_sql():
    assert set(QUERIES) - set(SQL) == {"link_mode_a", "link_mode_b", "link_mode_d"}


def test_a_module_that_fails_leaves_the_other_queries(monkeypatch):
    if entry.find_spec("tessera.llm") is None:
        pytest.skip("the subpackage is gone")
    import tessera.llm

    for name in ("tessera.llm.registry", "corpus_pipeline"):
        monkeypatch.delitem(sys.modules, name, raising=False)
    monkeypatch.setitem(sys.modules, "tessera.llm.packing", None)
    monkeypatch.delattr(tessera.llm, "packing", raising=False)
    with pytest.warns(UserWarning, match="left out"):
        found = entry.queries()
    assert set(found) == set(QUERIES)


def test_folded_cleaning_equals_python(spark, small):
    """By the reference's rules: accents folded, then legal words or punctuation out, then addresses spelt out."""
    import re
    import unicodedata

    from tessera.functions import text

    def fold(t):
        return "".join(c for c in unicodedata.normalize("NFKD", t or "") if not unicodedata.combining(c)).lower()

    def plain(t):
        return re.sub(r"[^a-zA-Z0-9\s]", " ", t)

    def name(t):
        return " ".join(plain(re.sub(rf"\b({'|'.join(text.COMPANY_WORDS)})\b", " ", fold(t))).split())

    def address(t):
        t = plain(fold(t))
        for word, to in text.ADDRESS_FORMS:
            t = re.sub(rf"\b{word}\b", to, t)
        return " ".join(t.split())

    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert any(not (r["text"] or "").isascii() for r in docs)
    cleaned = {"clean_name_folded": name, "clean_address_folded": address, "block_key_folded": lambda t: f"nt1:{name(t).split()[0]}" if name(t) else None}
    for query, f in cleaned.items():
        got = QUERIES[query](spark, small).collect()
        assert sorted((r[0], r[1]) for r in got) == sorted((r["doc_id"], f(r["text"])) for r in docs)
