"""Properties of the numpy kernels."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import suffixes
from tessera.llm.hashing import shingle_sets
from tessera.llm.tokens import CachedTokenizer

small = st.text("ab\x00c", min_size=1, max_size=40)


@settings(max_examples=80, deadline=None)
@given(st.lists(small, min_size=1, max_size=6))
def test_suffix_array_and_prefixes(texts):
    parts = [t.encode() for t in texts]
    sizes = np.array([len(p) for p in parts])
    raw, last = np.frombuffer(b"".join(parts), np.uint8), np.cumsum(sizes)
    text = np.repeat(np.arange(len(parts)), sizes)
    end = last[text]
    order = suffixes.suffix_array(raw, end, text)
    key = lambda p: ([x + 1 for x in raw[p : end[p]]] + [0], text[p])
    assert order.tolist() == sorted(range(len(raw)), key=key)
    got = suffixes.common_prefixes(raw, end, last - sizes, order)
    for k in range(1, len(order)):
        a, b = raw[order[k - 1] : end[order[k - 1]]], raw[order[k] : end[order[k]]]
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        assert got[k] == (differ[0] if len(differ) else n)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text("abcd", max_size=120), min_size=1, max_size=5))
def test_each_window_has_its_anchor(texts):
    length, gram = 20, 6
    parts = [t.encode() for t in texts]
    covered = {(k, p): False for k, t in enumerate(parts) for p in range(len(t) - length + 1)}
    for found in suffixes.anchors(parts, length, gram):
        for of, q, start, end in zip(found["of"], found["q"], found["start"], found["end"], strict=True):
            assert start <= q and q + gram <= end <= len(parts[of])
            for p in range(start, end - length + 1):
                covered[of, p] = True
    assert all(covered.values())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab \n", max_size=60), min_size=1, max_size=4))
def test_shingles(texts):
    for text, got in zip(texts, shingle_sets(texts, 3), strict=True):
        words = text.lower().split()
        assert len(got) == (len({tuple(words[i : i + 3]) for i in range(len(words) - 2)}) if len(words) >= 3 else 1)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=40), min_size=1, max_size=4))
def test_tokens_of_any_text(texts):
    tok = CachedTokenizer()
    assert tok.encode_all(texts) == [tok.whole(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.text("aAéÉßÄ'sst.,!12 \t\n-—“€½²ﬁ", max_size=60))
def test_tokens_of_latin_text(text):
    tok = CachedTokenizer()
    assert tok.encode(text) == tok.whole(text)


def test_components(spark):
    from tessera.llm.graph import components

    rng = np.random.default_rng(8)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(int(a), int(b)) for a, b in rng.integers(1000, 1200, (150, 2))]
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    expected = {n: root(n) for a, b in edges if a != b for n in (a, b)}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in got} == expected and len(got) == len(expected)
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0
