"""N-gram Jaccard join by MinHash banding.

Texts with equal sets of word shingles are one class. Bands of MinHash values of the classes are shuffled; classes that
share a band are candidates, verified on their full sets. A small component of candidates is compared as a whole, many to a
task. A large one is compared either as a whole or by its buckets (the classes that share a band), whichever copies fewer
sets; in both cases in a grid of blocks, so that no task gets an unbounded group. Of each block only link counts and a
spanning forest of its links leave the task, not its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import documents, skew_join, small_batches, stored, text_or_empty, whole_row, with_rows
from tessera.llm.graph import components
from tessera.llm.hashing import mixed, shingle_sets

WORDS = 5
#: Similarity as a fraction of whole numbers, so that it is decided exactly.
SIMILARITY = (4, 5)
RECALL, ROWS = 0.9995, 6
#: Classes of a block, and of a task of small components.
BLOCK, TASK = 512, 1000
#: Rows (of about 300 bytes) that are broadcast at most; beyond that the join shuffles.
BROADCAST_ROWS = 100_000
#: Columns of the incidence matrix at once.
CHUNK = 4096


def bands_for(similarity: float, recall: float = RECALL, rows: int = ROWS) -> int:
    """The least number of bands with which a pair of that similarity meets in one with that probability."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows)))


def band_hashes(sets: list[np.ndarray], bands: int, rows: int = ROWS) -> np.ndarray:
    """A hash of each band of MinHash values, for each of the sets, none of which is empty."""
    joined, sizes = np.concatenate(sets), np.array([len(s) for s in sets])
    first = np.cumsum(sizes) - sizes
    factors = np.random.default_rng(11).integers(0, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros((len(sets), bands), np.uint64)
    work = np.empty_like(joined)
    for k, factor in enumerate(factors):
        np.multiply(joined, factor, out=work)
        out[:, k // rows] = out[:, k // rows] * np.uint64(0x100000001B3) + mixed(np.minimum.reduceat(work, first))
    return mixed(out + np.arange(bands, dtype=np.uint64)).view(np.int64)


def set_key(shingles: np.ndarray) -> str:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).hexdigest()


def signatures(rows: DataFrame, words: int, bands: int) -> DataFrame:
    """doc_id, row, text_hash, set_key, bands for each of rows (doc_id, row, text)."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = list(shingle_sets(batch["text"].tolist(), words))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "row": batch["row"], "text_hash": batch["text_hash"], "set_key": [set_key(s) for s in sets], "bands": list(band_hashes(sets, bands))})

    return rows.withColumn("text_hash", F.xxhash64("text")).mapInPandas(sign, "doc_id long, row long, text_hash long, set_key string, bands array<long>")


def links(a: list[np.ndarray], b: list[np.ndarray] | None, similarity: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs of a set in a and one in b (or a later one in a) whose Jaccard similarity is reached."""
    both = a + (b or [])
    n = len(a)
    if len(both) == 2:
        common = np.array([[len(np.intersect1d(both[0], both[1], True))]])
        left, right = np.array([0]), np.array([0 if b else 1])
        common = common.ravel()
    else:
        shingles, owner = np.concatenate(both), np.repeat(np.arange(len(both)), [len(s) for s in both])
        _, column, number = np.unique(shingles, return_inverse=True, return_counts=True)
        shared = np.flatnonzero(number > 1)
        place = np.full(len(number), -1)
        place[shared] = np.arange(len(shared))
        column = place[column]
        keep = column >= 0
        column, owner = column[keep], owner[keep]
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        total = np.zeros((n, len(both) - n if b else n), np.float32)
        for at in range(0, len(shared), CHUNK):
            low, high = np.searchsorted(column, [at, at + CHUNK])
            m = np.zeros((len(both), min(CHUNK, len(shared) - at)), np.float32)
            m[owner[low:high], column[low:high] - at] = 1
            total += m[:n] @ (m[n:] if b else m).T
        left, right = np.nonzero(total) if b else np.nonzero(np.triu(total, 1))
        common = total[left, right].astype(np.int64)
    size = np.array([len(s) for s in both])
    p, q = similarity
    good = common * (p + q) >= p * (size[left] + size[right + n * bool(b)])
    return left[good], right[good]


def verified(key: tuple, rows: pd.DataFrame, similarity: tuple[int, int]) -> pd.DataFrame:
    """a, b, weight: for each class of a unit with links, the weight of its links here (b null), and forest edges (weight null).

    Pairs in a bucket that share an earlier band are left to that band's bucket.
    """
    out_a, out_b, out_w = [], [], []
    for _, part in rows.groupby("unit", sort=False):
        sets = [np.frombuffer(s, np.uint64) for s in part["shingles"]]
        node, weight, block = (part[c].to_numpy() for c in ("node", "weight", "block"))
        if part["i"].iloc[0] != part["j"].iloc[0]:
            one, two = np.flatnonzero(block == part["i"].iloc[0]), np.flatnonzero(block == part["j"].iloc[0])
            if not len(one) or not len(two):
                continue
            x, y = links([sets[k] for k in one], [sets[k] for k in two], similarity)
            x, y = one[x], two[y]
        else:
            if len(sets) < 2:
                continue
            x, y = links(sets, None, similarity)
        band = int(part["band"].iloc[0])
        if band > 0 and len(x):
            held = np.stack(part["bands"].to_list())[:, :band]
            first = ~(held[x] == held[y]).any(1)
            x, y = x[first], y[first]
        if not len(x):
            continue
        got = np.bincount(x, weight[y], len(node)) + np.bincount(y, weight[x], len(node))
        has = np.flatnonzero(got)
        out_a += node[has].tolist()
        out_b += [None] * len(has)
        out_w += got[has].astype(np.int64).tolist()
        parent = list(range(len(node)))

        def root(k: int, parent: list[int] = parent) -> int:
            while parent[k] != k:
                parent[k] = parent[parent[k]]
                k = parent[k]
            return k

        for s, t in zip(x.tolist(), y.tolist(), strict=True):
            s, t = root(s), root(t)
            if s != t:
                parent[max(s, t)] = min(s, t)
                out_a.append(int(node[max(s, t)]))
                out_b.append(int(node[min(s, t)]))
                out_w.append(None)
    return pd.DataFrame({"a": pd.array(out_a, "Int64"), "b": pd.array(out_b, "Int64"), "weight": pd.array(out_w, "Int64")})


def units(candidate: DataFrame, classes: DataFrame, buckets: DataFrame) -> tuple[DataFrame, bool]:
    """node, unit, m (its classes), band (-1 if a unit is a component): what each candidate is compared in; and whether any unit is a bucket."""
    sizes = stored(candidate.groupBy("label").agg(F.count("*").alias("m")), "sizes")
    cost = lambda n: F.col(n) * F.ceil(F.col(n) / BLOCK)  # copies of sets that a unit of n classes needs
    of = buckets.join(candidate.withColumnRenamed("node", "least"), "least").join(sizes.where(F.col("m") > BLOCK), "label")
    split = stored(of.groupBy("label", "m").agg(F.sum(cost("n")).alias("_cost")).where(F.col("_cost") < cost("m")).select("label", "m"), "split")
    whole = skew_join(candidate, sizes, "label", "m")
    component = lambda df: df.select("node", F.concat(F.lit("c"), "label").alias("unit"), "m", F.lit(-1).alias("band"))
    if split.isEmpty():
        return component(whole), False
    marked = skew_join(whole.drop("m"), split.withColumnRenamed("m", "_split"), "label", "_split")
    parts = stored(marked.join(sizes, "label"), "marked")
    apart = classes.join(parts.where("_split is not null").select("node"), "node", "left_semi").select("node", F.posexplode("bands").alias("band", "bucket"))
    apart = skew_join(apart, buckets.select("bucket", "n"), "bucket", "n").where("n is not null")
    return component(parts.where("_split is null")).unionByName(apart.select("node", F.concat(F.lit("b"), "bucket").alias("unit"), F.col("n").alias("m"), "band")), True


def near_duplicates(docs: DataFrame, words: int = WORDS, similarity: tuple[int, int] = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """doc_id, text_hash, class_id, links, class_key for each row of docs.

    Two rows are linked if the Jaccard similarity of their sets of word shingles is similarity or more; words are in lower
    case and stand between characters that are no letters or digits. links: with how many other rows this row is linked.
    class_key: a number for each component of links; class_id: its least doc_id, null if none has one. Null texts count as
    empty; texts without words are linked with each other. Repeated rows and repeated ids count row by row, null ids like any
    other row. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    bands = bands_for(similarity[0] / similarity[1], recall)
    rows = with_rows(docs)
    signed = stored(signatures(rows, words, bands), "signed")
    grouped = signed.groupBy("set_key").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least_id"), F.min("row").alias("row"), F.first("bands").alias("bands"))
    classes = stored(grouped.withColumn("node", F.monotonically_increasing_id()), "classes")

    exploded = classes.select("node", F.explode("bands").alias("bucket"))
    buckets = stored(exploded.groupBy("bucket").agg(F.min("node").alias("least"), F.count("*").alias("n")).where("n > 1"), "buckets")
    met = skew_join(exploded, buckets, "bucket", "n").where("least is not null and least <> node")
    candidate = stored(components(met.select(F.col("node").alias("a"), F.col("least").alias("b"))), "candidates")

    placed, apart = units(candidate, classes, buckets)
    side = F.ceil(F.col("m") / BLOCK).cast("int")
    unit = F.struct("unit", "band", side.alias("side"), F.pmod(F.xxhash64("node"), side).cast("int").alias("block"))
    placed = placed.groupBy("node").agg(F.collect_list(unit).alias("units"))  # one unit, or as many as there are bands
    want = placed.join(classes.select("node", "set_key", "row", F.col("copies").alias("weight"), *(["bands"] if apart else [F.lit(None).cast("array<long>").alias("bands")])), "node")
    want = stored(want.withColumnRenamed("set_key", "want_key"), "want")
    number = want.count()
    texts = rows.select("row", "text").join(F.broadcast(want) if number <= BROADCAST_ROWS and not apart else want, "row")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = list(shingle_sets(batch["text"].tolist(), words))
            if any(set_key(s) != k for s, k in zip(found, batch["want_key"], strict=True)):
                raise ValueError("rows changed between two reads of the documents")
            yield batch.drop(columns=["text", "want_key", "row"]).assign(shingles=[s.tobytes() for s in found])

    full = texts.mapInPandas(sets, "node long, units array<struct<unit: string, band: int, side: int, block: int>>, weight long, bands array<long>, shingles binary")
    cells = full.withColumn("_u", F.explode("units")).select("node", "weight", "bands", "shingles", "_u.*")
    other = F.explode(F.sequence(F.lit(0), F.col("side") - 1))
    cells = cells.withColumn("other", other).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    tasks = max(1, -(-number // TASK))
    cells = cells.withColumn("cell", F.when(F.col("side") == 1, F.pmod(F.xxhash64("unit"), F.lit(tasks)).cast("string")).otherwise(F.concat_ws(":", F.lit("grid"), "unit", "i", "j")))
    checked = cells.groupBy("cell").applyInPandas(lambda key, part: verified(key, part, similarity), "a long, b long, weight long")
    checked = stored(checked, "checked")

    label = components(checked.where("b is not null"))
    of = checked.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("weight").alias("others"))
    found = classes.select("node", "set_key", "copies", "least_id").join(label, "node", "left").join(of, "node", "left")
    found = found.withColumn("class_key", F.coalesce("label", "node"))
    least = found.where("label is not null").groupBy(F.col("label").alias("_label")).agg(F.min("least_id").alias("_least"), F.count("*").alias("_n"))
    found = skew_join(found, stored(least, "least").withColumnRenamed("_label", "label"), "label", "_n")
    found = found.select("set_key", "copies", "class_key", F.when(F.col("label").isNotNull(), F.col("_least")).otherwise(F.col("least_id")).alias("class_id"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"))
    got = skew_join(signed.select("doc_id", "text_hash", "set_key"), stored(found, "found"), "set_key", "copies")
    return got.select("doc_id", "text_hash", "class_id", "links", "class_key")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of docs, with its columns, that have the least doc_id of their class of near-duplicates; one row for a class of equal rows or without ids."""
    none = F.lit(-(1 << 63))
    keep = near_duplicates(docs).where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("class_key").agg(F.min(F.struct("doc_id", "text_hash")).alias("_k"))
    keep = keep.select(F.coalesce("_k.doc_id", none).alias("_id"), F.col("_k.text_hash").alias("_hash"))
    rows = whole_row(docs).select("_row", F.coalesce(F.col("doc_id").cast("long"), none).alias("_id"), F.xxhash64(text_or_empty()).alias("_hash"))
    return rows.join(keep, ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"]).select("_row.*")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "class_id", "links")


SQL_OP1 = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '(?:[a-z0-9]|[^\x00-\x7F])+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) ELSE [array_to_string(w, ' ')] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 9 * c >= 4 * (x.n + y.n)),
r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other)
SELECT r.doc_id, min(other) AS class_id, (SELECT count(*) FROM l WHERE l.a = r.doc_id) AS links FROM r GROUP BY r.doc_id
"""

QUERIES, SQL = {"op1_ngram_join": op1_ngram_join}, {"op1_ngram_join": SQL_OP1}
