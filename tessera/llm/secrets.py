"""Scans for secrets.

Three kinds are patterns. The fourth, entropy, looks at every long string of one character class: a window slides over it,
the Shannon entropy of the window's characters being updated from the two counts that change with each step, and windows
above the class's threshold become spans. Strings that an allow list knows are not reported.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import documents, small_batches

# The patterns of the three base kinds, and the least length of group 2 or of the match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGN, LEAST_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "entropy")

LOWER, UPPER, DIGIT = str.islower, str.isupper, str.isdigit
#: Class of characters, window, bits a character from which a window counts, and kinds of characters that a span must hold.
#: Bits for windows of 20 are what about 99 of 100 random windows of that alphabet reach (hex 2.90, base32 3.32, lower case
#: with digits 3.38, mixed and base64 3.65). The last class also takes separators of either sort and any case.
CLASSES = (
    (re.compile(r"[0-9A-Fa-f]{20,}"), 20, 2.9, (str.isalpha, DIGIT)),
    (re.compile(r"[0-9a-z]{20,}"), 20, 3.38, (LOWER, DIGIT)),
    (re.compile(r"[0-9A-Z]{20,}={0,6}"), 20, 3.32, (UPPER, DIGIT)),
    (re.compile(r"[A-Za-z0-9]{20,}"), 20, 3.65, (LOWER, UPPER, DIGIT)),
    (re.compile(r"[A-Za-z0-9+/]{20,}={0,2}"), 20, 3.65, (LOWER, UPPER, DIGIT)),
    (re.compile(r"[A-Za-z0-9_-]{20,}={0,2}"), 20, 3.65, (LOWER, UPPER, DIGIT)),
    (re.compile(r"[A-Za-z0-9+/_-]{24,}={0,2}"), 24, 4.0, (str.isalpha, DIGIT)),
)
#: What holds any run of a class.
RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,6}")
#: Placeholders and counting rows: the part of a string in which one stands, up to the next of SEPARATORS, is no secret.
PLACEHOLDER = re.compile(r"(?i)example|sample|placeholder|changeme|your(?=[_-])|dummy|redacted|x{6,}|0123456789|abcdefghij|qwertyuiop|fedcba")
SEPARATORS = re.compile(r"[_/-]")
#: Whole strings that are no secrets, however even their characters: unique ids, digits or letters alone, paths of words.
ALLOWED = (
    re.compile(r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"),
    re.compile(r"^[0-9_+/-]+$"),
    re.compile(r"^[A-Za-z_+/-]+$"),
    re.compile(r"^(?:[A-Za-z]{2,}[0-9]{0,2}[/_+-])+[A-Za-z]*[0-9]{0,2}$"),
)
#: c log2 c for the counts in a window.
TERM = [0.0, *(c * math.log2(c) for c in range(1, 65))]

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def high_windows(string: str, window: int, least: float) -> list[tuple[int, int]]:
    """Where windows of that width have an entropy of least bits or more, joined where they overlap or touch."""
    if len(string) < window:
        return []
    count: dict[str, int] = {}
    total, goal, out = 0.0, (math.log2(window) - least) * window, []
    for i, c in enumerate(string):
        n = count.get(c, 0)
        total += TERM[n + 1] - TERM[n]
        count[c] = n + 1
        if i >= window:
            d = string[i - window]
            n = count[d]
            total += TERM[n - 1] - TERM[n]
            count[d] = n - 1
        if i >= window - 1 and total <= goal + 1e-9:
            start = i - window + 1
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((start, i + 1))
    return out


def suspects(pattern: re.Pattern, text: str, start: int, end: int) -> Iterator[tuple[int, str]]:
    """Where the strings of a class begin in a part of text, and what they are, without parts that hold a placeholder."""
    for m in pattern.finditer(text, start, end):
        whole = m.group()
        if not PLACEHOLDER.search(whole):
            yield m.start(), whole
            continue
        edges = [0, *(s.end() for s in SEPARATORS.finditer(whole)), len(whole)]
        first = None
        for a, b in zip(edges, edges[1:], strict=False):
            if PLACEHOLDER.search(whole, a, b):
                if first is not None:
                    yield m.start() + first, whole[first:a]
                first = None
            elif first is None:
                first = a
        if first is not None:
            yield m.start() + first, whole[first:]


def entropy_spans(text: str) -> list[Span]:
    """Spans of even characters that hold both digits and letters; those of all classes are joined where they overlap."""
    found = []
    for run in RUN.finditer(text):
        for pattern, window, least, kinds in CLASSES:
            for begin, whole in suspects(pattern, text, run.start(), run.end()):
                if any(a.search(whole) for a in ALLOWED):
                    continue
                for start, end in high_windows(whole, window, least):
                    part = whole[start:end]
                    if all(any(map(kind, part)) for kind in kinds):
                        found.append((begin + start, begin + end))
    out: list[Span] = []
    for start, end in sorted(found):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]), "entropy")
        else:
            out.append((start, end, "entropy"))
    return out


def within(spans: list[Span], others: list[Span]) -> set[Span]:
    """Those of spans that lie within one of others: as others by start are passed, the farthest end so far decides."""
    out, at, reach = set(), 0, -1
    others = sorted(others)
    for span in sorted(spans):
        while at < len(others) and others[at][0] <= span[0]:
            reach = max(reach, others[at][1])
            at += 1
        if span[1] <= reach:
            out.add(span)
    return out


def secret_spans(text: str) -> list[Span]:
    """All spans by start, then kind as listed in KINDS. An entropy span within a base span says nothing new and is left out."""
    base, more = base_spans(text), entropy_spans(text)
    known = within(more, base)
    return sorted([*base, *(s for s in more if s not in known)], key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, spans array of (start, end, kind) in code points, end exclusive, for each row of docs, repeated ones too. Null texts count as empty and have none; other columns are not read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [[{"start": a, "end": b, "kind": k} for a, b, k in secret_spans(t)] if isinstance(t, str) else [] for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "spans": found})

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, "doc_id long, spans array<struct<start: long, end: long, kind: string>>")


def redacted(docs: DataFrame) -> DataFrame:
    """docs with each secret in text replaced by its kind in angle brackets, overlapping ones together, and n_chars to match.

    Other columns, null, empty and clean texts stay as they are. Repeated rows are changed alike, row by row; no rows give none.
    """

    def clean(text: str) -> str:
        out, at, spans = [], 0, secret_spans(text)
        for start, end, kind in spans:
            if start >= at:
                out += [text[at:start], f"<{kind}>"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: clean(t) if isinstance(t, str) else None)

    small_batches(docs.sparkSession)
    got = docs.withColumn("text", F.pandas_udf(run, "string")(F.col("text")))
    return got.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long"))) if "n_chars" in docs.columns else got


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return found.select("doc_id", number("assign"), number("access"), number("hex"), F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"), number("entropy"))


_KEYS = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in key) for key in ("password", "passwd", "secret", "token", "api_?key"))
_SQL_ASSIGN = rf"""(?:{_KEYS})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_SQL_KINDS = {str.isalpha: "[A-Za-z]", LOWER: "[a-z]", UPPER: "[A-Z]", DIGIT: "[0-9]"}
_SQL_CLASSES = ", ".join(f"({i}, {w}, {least}::DOUBLE, [{', '.join(repr(_SQL_KINDS[k]) for k in kinds)}])" for i, (_, w, least, kinds) in enumerate(CLASSES))


def _sql_found(name: str, table: str, keys: str, text: str, pattern: str) -> str:
    """CTEs that end in name: keys, m, s for each match m of a pattern in the column text of table, s code points before it. What stands between matches tells where they are."""
    return f"""{name}_cut AS (SELECT {keys}, unnest(range(0, len(string_split_regex({text}, '{pattern}')))) AS i, unnest(string_split_regex({text}, '{pattern}')) AS g, unnest(regexp_extract_all({text}, '{pattern}')) AS m FROM {table}),
{name} AS (SELECT * FROM (SELECT {keys}, m, (sum(length(g) + coalesce(length(m), 0)) OVER (PARTITION BY {keys} ORDER BY i) - coalesce(length(m), 0))::BIGINT AS s FROM {name}_cut) WHERE m IS NOT NULL)"""


_SQL_STRINGS = ",\n".join(f"""{_sql_found(f"c{i}", "runs", "rid, s0", "run", p.pattern)}""" for i, (p, *_) in enumerate(CLASSES))
_SQL_OF_CLASS = " UNION ALL ".join(f"SELECT rid, s0 + s AS begin, {i} AS class, m AS whole FROM c{i}" for i in range(len(CLASSES)))
SQL_OP2 = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
{_sql_found("assign", "docs", "rid", "text", _SQL_ASSIGN)},
{_sql_found("access", "docs", "rid", "text", "AKIA[A-Z0-9]+")},
{_sql_found("hex", "docs", "rid", "text", "[0-9a-f]+")},
base AS (SELECT rid, 0 AS k, s, s + length(m) AS e FROM assign WHERE length(regexp_extract(m, '{_SQL_ASSIGN}', 1)) >= {LEAST_ASSIGN}
  UNION ALL SELECT rid, 1, s, s + length(m) FROM access WHERE length(m) >= {LEAST_ACCESS} UNION ALL SELECT rid, 2, s, s + length(m) FROM hex WHERE length(m) >= 16),
{_sql_found("run", "docs", "rid", "text", RUN.pattern)},
runs AS (SELECT rid, s AS s0, m AS run FROM run),
{_SQL_STRINGS},
strings AS (SELECT row_number() OVER () AS sid, * FROM ({_SQL_OF_CLASS})),
{_sql_found("part", "strings", "rid, sid, begin, class", "whole", "[^_/-]*[_/-]|[^_/-]+")},
marked AS (SELECT *, regexp_matches(m, '{PLACEHOLDER.pattern.replace("(?=[_-])", "[_-]")}') AS bad FROM part),
islands AS (SELECT *, sum(bad::INT) OVER (PARTITION BY sid ORDER BY s) AS island FROM marked),
clear AS (SELECT rid, sid, class, begin + min(s) AS begin, string_agg(m, '' ORDER BY s) AS whole FROM islands WHERE NOT bad GROUP BY rid, sid, class, begin, island),
classes(class, w, least, kinds) AS (VALUES {_SQL_CLASSES}),
suspect AS (SELECT row_number() OVER () AS pid, * FROM clear JOIN classes USING (class) WHERE length(whole) >= w AND NOT ({" OR ".join(f"regexp_matches(whole, '{a.pattern}')" for a in ALLOWED)})),
windows AS (SELECT pid, w, least, i, substr(whole, i + 1, w) AS win FROM (SELECT *, unnest(range(0, length(whole) - w + 1)) AS i FROM suspect)),
high AS (SELECT pid, i, w FROM windows WHERE list_sum(list_transform(map_values(list_histogram(string_split(win, ''))), lambda c: c * log2(c))) <= (log2(w) - least) * w + 1e-9),
joins AS (SELECT *, sum(apart) OVER (PARTITION BY pid ORDER BY i) AS island FROM (SELECT *, (i > coalesce(lag(i) OVER (PARTITION BY pid ORDER BY i) + w, -1))::INT AS apart FROM high)),
even AS (SELECT pid, min(i) AS a, max(i) + any_value(w) AS b FROM joins GROUP BY pid, island),
span AS (SELECT DISTINCT rid, begin + a AS s, begin + b AS e FROM even JOIN suspect USING (pid) WHERE len(list_filter(kinds, lambda k: NOT regexp_matches(substr(whole, a + 1, b - a), k))) = 0),
over AS (SELECT *, sum(apart) OVER (PARTITION BY rid ORDER BY s, e) AS island FROM (SELECT *, (s >= coalesce(max(e) OVER (PARTITION BY rid ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::INT AS apart FROM span)),
entropy AS (SELECT rid, 3 AS k, min(s) AS s, max(e) AS e FROM over GROUP BY rid, island),
found AS (SELECT * FROM base UNION ALL SELECT * FROM entropy x WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = x.rid AND b.s <= x.s AND x.e <= b.e)),
named AS (SELECT *, ['assign', 'access', 'hex', 'entropy'][k + 1] || ':' || s || ':' || e AS line FROM found)
SELECT any_value(doc_id) AS doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  sha256(coalesce(string_agg(line, ',' ORDER BY s, k, e) FILTER (k < 3), '')) AS base_sha256, coalesce(string_agg(line, ',' ORDER BY s, k, e), '') AS spans,
  count(*) FILTER (k = 3) AS n_entropy FROM docs LEFT JOIN named USING (rid) GROUP BY rid
"""

QUERIES, SQL = {"op2_secrets": op2_secrets}, {"op2_secrets": SQL_OP2}
