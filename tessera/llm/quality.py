"""Quality classifier by supervised subword embeddings.

Words, pairs of neighbouring words and the character n-grams of words are hashed into one table of learned vectors. A
document is the average of the vectors of all that stands in it, and a softmax over a linear map of that average gives its
classes. Training is stochastic gradient descent in numpy on a bounded sample of labelled documents; scoring runs over
whole texts in the executors, where each vector has been reduced to the one number that it adds to the log odds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import documents, small_batches

#: Entries of the table of vectors, and their length.
TABLE, DIM = 1 << 16, 12
NGRAMS = (2, 3, 4)
#: Labelled documents of each class that training reads at most, those with the smallest hashes of their ids, and bytes of
#: their features, of which the documents of greater hashes are left out beyond that.
SAMPLE, SAMPLE_BYTES = 1500, 192 << 20
EPOCHS, RATE, SEED = 6, 0.5, 7
THRESHOLD = 0.3
#: Bytes of text that are hashed at once.
BLOCK = 1 << 18

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _slot(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h + np.uint64(salt)) * _PRIME
    return ((h ^ (h >> np.uint64(29))) * _PRIME >> np.uint64(64 - TABLE.bit_length() + 1)).astype(np.int64)


def features(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For some of the texts at a time, in order: the number of each one's features, and the table entries of all.

    Features: n-grams over the UTF-8 bytes of words with a blank on each side, none of which is all of that, the words, and pairs of neighbouring words.
    A text without words has none.
    """
    at = 0
    encoded = [b" " + t.encode("utf-8", "replace") + b" " for t in texts]
    while at < len(encoded):
        end, total = at, 0
        while end < len(encoded) and (end == at or total + len(encoded[end]) <= BLOCK):
            total += len(encoded[end])
            end += 1
        sizes = np.array([len(e) for e in encoded[at:end]])
        raw = np.frombuffer(b"".join(encoded[at:end]), np.uint8)
        space = _SPACE[raw]
        b = np.where(space, np.uint8(32), raw).astype(np.uint64)
        first = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(sizes)), sizes)
        found, owners = [], []
        for n in NGRAMS:
            if len(b) < n:
                continue
            last = len(b) - n + 1
            h = b[:last].copy()
            inner = np.zeros(last, bool)
            for j in range(1, n):
                h = h * np.uint64(257) + b[j : j + last]
                if j < n - 1:
                    inner |= space[j : j + last]
            keep = np.flatnonzero(~(inner | (space[:last] & space[n - 1 :])))
            found.append(_slot(h[keep], n))
            owners.append(owner[keep])
        starts = np.flatnonzero(~space[1:] & space[:-1]) + 1
        if len(starts):
            ends = np.flatnonzero(space[1:] & ~space[:-1]) + 1
            power = np.cumprod(np.full(int((ends - starts).max()) + 1, 0x100000001B3, np.uint64))
            length = ends - starts
            inside = np.flatnonzero(~space)
            word_of = np.repeat(np.arange(len(starts)), length)
            value = (b[inside] + np.uint64(1)) * power[inside - starts[word_of]]
            word = np.add.reduceat(value, np.cumsum(length) - length)
            of = owner[starts]
            pair = word * np.uint64(31) ^ np.roll(word, -1)
            pair[word == np.roll(word, -1)] = 1  # a word said twice is one feature, whatever the word
            found += [_slot(word, 101), _slot(pair[:-1][of[:-1] == of[1:]], 103)]
            owners += [of, of[:-1][of[:-1] == of[1:]]]
        entries, own = np.concatenate(found), np.concatenate(owners)
        order = np.argsort(own, kind="stable")
        yield np.bincount(own, minlength=len(first)), entries[order]
        at = end


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = SAMPLE_BYTES) -> DataFrame:
    """doc_id, label and the features of the sampled labelled documents: entries and counts, as bytes.

    Rows without doc_id or label are left out, an id with both labels counts as 0, and of several rows of an id the least
    text counts. At most sample documents of each class, and about most bytes of them together. Null texts have no features.
    """
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("label"))
    picked = [known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    picked = picked[0].unionByName(picked[1])

    small_batches(docs.sparkSession)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for sizes, entries in features([t or "" for t in batch["text"]]):
                for part in np.split(entries, np.cumsum(sizes)[:-1]):
                    e, n = np.unique(part, return_counts=True)
                    rows.append((e.astype("<i4").tobytes(), n.astype("<f4").tobytes()))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "entries": [r[0] for r in rows], "counts": [r[1] for r in rows]})

    got = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(picked), "doc_id")  # at most 2 * sample rows
    got = got.groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # partial: a repeated id leaves a task once
    got = got.mapInPandas(hashed, "doc_id long, label int, entries binary, counts binary")
    upto = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # sample rows at most
    held = F.sum(F.octet_length("entries") + F.octet_length("counts")).over(upto)
    return got.withColumn("_held", held).where(F.col("_held") <= most // 2).drop("_held")


def learnt(rows: list, share: tuple[float, float] = (0.5, 0.5), epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The learned vectors of all table entries, and weights and biases of the classes. rows: label, entries, counts, of both classes.

    share: of each class among all labels, by which the sampled rows weigh; rows are taken in an order that seed decides.
    Each step goes down the gradient of the log loss of one document, steps of a document's vectors scaled by the root of
    their number.
    """
    rng = np.random.default_rng(seed)
    data = [(int(r[0]), np.frombuffer(r[1], "<i4"), np.frombuffer(r[2], "<f4")) for r in sorted(rows, key=lambda r: (r[0], r[1], r[2]))]
    data = [(y, e, c / c.sum()) for y, e, c in data]
    held = np.bincount([y for y, _, _ in data], minlength=2)
    vectors = rng.normal(0, 1 / DIM, (TABLE, DIM)).astype(np.float32)
    out, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    weight = np.array(share) * len(data) / held
    steps, done = epochs * len(data), 0
    for _ in range(epochs):
        for i in rng.permutation(len(data)):
            y, e, c = data[i]
            now = rate * (1 - done / steps) * weight[y]
            done += 1
            step_vectors, step_out, step_bias = gradient(vectors[e], c, out, bias, y)
            out -= now * step_out
            bias -= now * step_bias
            vectors[e] -= now * len(e) ** 0.5 * step_vectors
    return vectors, out, bias


def gradient(vectors: np.ndarray, share: np.ndarray, out: np.ndarray, bias: np.ndarray, label: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the log loss of a document with these vectors in these shares: by vector, by class weights, by class biases."""
    mean = share @ vectors
    z = out @ mean + bias
    p = np.exp(z - z.max())
    p /= p.sum()
    p[label] -= 1
    return share[:, None] * (out.T @ p), np.outer(p, mean), p


def train(rows: list, share: tuple[float, float] = (0.5, 0.5), epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> tuple[np.ndarray, float]:
    """The log odds of label 1 that each table entry adds, and the bias. rows: label, entries, counts; those without entries are left out.

    With rows of one class or none, the odds are those of the class alone or even.
    """
    rows = [r for r in rows if len(r[1])]
    held = np.bincount([int(r[0]) for r in rows], minlength=2)
    if not held.all():
        return np.zeros(TABLE, np.float32), float(np.sign(held[1] - held[0])) * 4
    vectors, out, bias = learnt(rows, share, epochs, rate, seed)
    return vectors @ (out[1] - out[0]), float(bias[1] - bias[0])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """train() on the sampled rows of docs, each class weighing as it does among all labels. Repeated ids count once; without documents or labels the odds are even."""
    rows = training_rows(docs, labels, sample).select("label", "entries", "counts").collect()  # at most 2 * sample rows and SAMPLE_BYTES
    of = dict(labels.where("quality in (0, 1)").groupBy("quality").count().collect())
    total = max(1, sum(of.values()))
    return train(rows, (of.get(0, 0) / total, of.get(1, 0) / total))


def scored(docs: DataFrame, model: tuple[np.ndarray, float], column: str = "score", text: str = "text") -> DataFrame:
    """docs with the probability of label 1, by the text that stands in text, in column, which replaces one of that name. Null and empty texts get the model's answer for no evidence."""
    odds, bias = model
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((np.asarray(odds, np.float32), float(bias)))  # TABLE numbers

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table, at_none = shared.value
        for texts in batches:
            out = []
            for sizes, entries in features([t if isinstance(t, str) else "" for t in texts]):
                end = np.concatenate([[0.0], np.cumsum(table[entries], dtype=np.float64)])
                last = np.cumsum(sizes)
                out.append((end[last] - end[last - sizes]) / np.maximum(sizes, 1) + at_none)
            z = np.concatenate(out) if out else np.zeros(0)
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return docs.withColumn(column, F.pandas_udf(score, "double")(F.col(text)))


def held_out() -> F.Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> tuple[np.ndarray, float]:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    return fit(docs, labels)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    got = scored(docs.select("doc_id", "text"), quality_model(spark, docs, sf_dir))
    return got.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


QUERIES, SQL = {"op8_quality": op8_quality}, {}
