"""The queries that SQL can express, against that SQL on the smallest tables."""

import hashlib
import os
import random
import string

import duckdb
import pandas as pd
import pytest

from tessera.llm import secrets
from tessera.llm.common import release, shared_folder, stored
from tessera.llm.registry import QUERIES, SQL


@pytest.fixture(scope="module")
def duck(small):
    made = duckdb.connect()
    for name in os.listdir(small):
        made.execute(f"create view {name.split('.')[0]} as select * from read_parquet('{small}/{name}')")
    return made


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, small, name):
    got, expected = QUERIES[name](spark, small), duck.sql(SQL[name])
    columns = sorted(expected.columns)
    assert sorted(got.columns) == columns
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=key) == sorted(expected.project(", ".join(columns)).fetchall(), key=key)


def test_sql_of_secrets_on_random_texts():
    """The tables hold few entropy spans outside base ones; these texts hold thousands, beside placeholders, separators and letters beyond ASCII."""
    rng = random.Random(5)
    letters = string.ascii_letters + string.digits
    alphabets = ("0123456789abcdef", string.ascii_lowercase + string.digits, string.ascii_uppercase + "234567", letters, letters + "+/", letters + "_-", "0123456789ABCDEFabcdef")
    words = ("example", "your_", "sample", "password=", 'api_key: "', "token", "AKIA", "xxxxxxxx", "-", "_", "/", "é", "💥", "\n", "==", "=", "some words", "0123456789", "ſecret=", "apiKey='", " ")

    def text():
        return "".join("".join(rng.choices(rng.choice(alphabets), k=rng.randint(5, 60))) if rng.random() < 0.4 else rng.choice(words) for _ in range(rng.randint(0, 16)))

    documents = pd.DataFrame({"doc_id": range(3000), "text": [None, *(text() for _ in range(2999))]})
    made = duckdb.connect()
    made.register("documents", documents)
    spans = [secrets.secret_spans(t or "") for t in documents["text"]]
    count = lambda s, kind: sum(x[2] == kind for x in s)
    base = [secrets.joined([x for x in s if x[2] != "entropy"]) for s in spans]
    expected = [(i, count(s, "assign"), count(s, "access"), count(s, "hex"), hashlib.sha256(b.encode()).hexdigest(), secrets.joined(s), count(s, "entropy")) for i, (s, b) in enumerate(zip(spans, base, strict=True))]
    assert sorted(made.sql(SQL["op2_secrets"]).fetchall()) == expected
    assert sum(e[6] for e in expected) > 1000


def test_release(spark):
    stored(spark.range(3), "test")
    folder = shared_folder(spark).removeprefix("file://")
    assert any(n.startswith("tessera-test") for n in os.listdir(folder))
    release(spark)
    assert not any(n.startswith("tessera-test") for n in os.listdir(folder))
