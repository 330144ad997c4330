"""Exact top-k search with a vector-approximation file.

Every component of every vector is quantised to one of a few cells; the file holds the cells of all vectors, in blocks. A
search scans that file alone, in place, for as many queries at once as a fixed number of bytes holds: cells bound each score
from below and above. The first scan finds each query's k-th best lower bound among all vectors, the second the vectors
whose upper bound reaches it, which are the candidates. Exact vectors are then read in the order of their bounds, and of the
rest only those whose bound still reaches the k-th exact score. Equal vectors stand in the file once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import small_batches, stored

K, SCALE, QUERIES_EVERY = 20, 64, 20
#: Cells of a component.
CELLS = 64
#: Queries of a block, and bytes of queries that are sent to all tasks at once.
QUERY_BLOCK, SENT_BYTES = 2048, 32 << 20


def whole_numbers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v: components as floor(scale * x). Rows whose id or vector is null, or whose vector holds a null, NaN or infinity, take no part; an empty vector is one of no components."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    floors = F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(good).select("vec_id", floors.alias("v"))


def classes(vectors: DataFrame, keep: int) -> DataFrame:
    """class_id (the least vec_id), v, ids (the keep least vec_ids, ascending): a row for each different vector. At most keep rows of a vector leave a task."""
    least = vectors.withColumn("_n", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("_n") <= keep)
    return least.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.col("ids")[0].alias("class_id"), "v", "ids")


def ranges(vectors: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each number of components: the least value and the width of a cell of each component."""
    parts = vectors.select(F.size("v").alias("dim"), F.posexplode("v").alias("at", "x")).groupBy("dim", "at").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim, at, low, high in parts.collect():  # a row for each component
        lows, widths = out.setdefault(dim, (np.zeros(dim, np.int64), np.ones(dim, np.int64)))
        lows[at], widths[at] = low, -(-(high - low + 1) // CELLS)
    return out


def cells_of(cells: dict, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return cells[dim] if dim else (np.zeros(0, np.int64), np.ones(0, np.int64))


def approximations(found: DataFrame, cells: dict) -> DataFrame:
    """dim, n, ids, cells: the file, a row for each block of vectors, one byte for each component."""

    def quantise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, rows in batch.groupby(batch["v"].map(len)):
                low, width = cells_of(cells, int(dim))
                v = np.stack(rows["v"].to_list()).astype(np.int64)
                yield pd.DataFrame({"dim": [int(dim)], "n": [len(rows)], "ids": [rows["class_id"].to_numpy(np.int64).tobytes()], "cells": [((v - low) // width).astype(np.uint8).tobytes()]})

    return found.select("class_id", "v").mapInPandas(quantise, "dim int, n int, ids binary, cells binary")


def query_blocks(queries: DataFrame, size: int) -> tuple[DataFrame, int]:
    """dim, q, ids, vectors: queries in blocks of about size, and the number of blocks."""
    number = max(1, -(-queries.count() // size))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (dim, q), rows in batch.groupby([batch["v"].map(len), batch["q"]]):
                yield pd.DataFrame({"dim": [int(dim)], "q": [int(q)], "ids": [rows["vec_id"].to_numpy(np.int64).tobytes()], "vectors": [np.stack(rows["v"].to_list()).astype(np.int64).tobytes()]})

    return queries.withColumn("q", F.pmod(F.xxhash64("vec_id"), F.lit(number)).cast("int")).repartition(number, "q").mapInPandas(pack, "dim int, q int, ids binary, vectors binary"), number


def bounds(q: np.ndarray, c: np.ndarray, low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of queries q (rows) with vectors in cells c (rows), whole numbers."""
    least = low + c.astype(np.int64) * width
    far = max(int(np.abs(least).max(initial=0)), int(np.abs(least + width).max(initial=0)))
    limit = int(np.abs(q).max(initial=0)) * far * q.shape[1]
    kind = np.float32 if limit < 1 << 24 else np.float64 if limit < 1 << 53 else object
    at_least = q.astype(kind) @ least.T.astype(kind)
    spread = (width - 1).astype(kind)
    return at_least + (np.minimum(q, 0).astype(kind) @ spread)[:, None], at_least + (np.maximum(q, 0).astype(kind) @ spread)[:, None]


def unpacked(blocks: list, reach: dict[int, tuple[int, int]] | None = None) -> dict[int, list]:
    """Blocks of queries by their number of components: ids, vectors and, where reach is given, the bound and the id that it asks for."""
    out: dict[int, list] = {}
    for b in blocks:
        ids = np.frombuffer(b["ids"], np.int64)
        asked = [(reach or {}).get(i, (None, 0)) for i in ids.tolist()]
        low, last = np.array([-np.inf if x is None else x for x, _ in asked]), np.array([i for _, i in asked], np.int64)
        out.setdefault(b["dim"], []).append((ids, np.frombuffer(b["vectors"], np.int64).reshape(len(ids), b["dim"]), low, last))
    return out


def least_bounds(file: DataFrame, sent: Broadcast, cells: dict, k: int) -> DataFrame:
    """query_id, reach (low, id): the k-th best lower bound of each query that has so many, ties to the smaller id, and whose it is."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks, best = unpacked(sent.value), {}
        for batch in batches:
            for dim, n, ids, raw in zip(batch["dim"].tolist(), batch["n"].tolist(), batch["ids"], batch["cells"], strict=True):
                c, ids = np.frombuffer(raw, np.uint8).reshape(n, dim), np.frombuffer(ids, np.int64)
                for at, (query_ids, q, _, _) in enumerate(blocks.get(dim, [])):
                    least, of = bounds(q, c, *cells_of(cells, dim))[0], np.broadcast_to(ids, (len(query_ids), n))
                    if (dim, at) in best:
                        least, of = np.concatenate([best[dim, at][0], least], 1), np.concatenate([best[dim, at][1], of], 1)
                    if least.shape[1] > k:
                        top = np.argpartition(-least, k - 1, 1)[:, :k]
                        least, of = np.take_along_axis(least, top, 1), np.take_along_axis(of, top, 1)
                    best[dim, at] = least, of
        for (dim, at), (least, of) in best.items():
            yield pd.DataFrame({"query_id": blocks[dim][at][0], "down": list(-least.astype(np.int64)), "ids": list(of)})

    lows = file.mapInPandas(scan, "query_id long, down array<long>, ids array<long>")
    best = F.get(F.sort_array(F.flatten(F.collect_list(F.arrays_zip("down", "ids")))), F.lit(k - 1))
    return lows.groupBy("query_id").agg(best.alias("best")).where("best is not null").select("query_id", F.struct((-F.col("best.down")).alias("low"), F.col("best.ids").alias("id")).alias("reach"))


def candidates(file: DataFrame, sent: Broadcast, reach: dict[int, tuple[int, int]], cells: dict) -> DataFrame:
    """query_id, class_id, high: the vectors whose upper bound reaches a query's k-th lower bound. Of those that can only equal it, vectors of greater ids than the k-th are behind k others."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks = unpacked(sent.value, reach)
        for batch in batches:
            for dim, n, ids, raw in zip(batch["dim"].tolist(), batch["n"].tolist(), batch["ids"], batch["cells"], strict=True):
                c, ids = np.frombuffer(raw, np.uint8).reshape(n, dim), np.frombuffer(ids, np.int64)
                for query_ids, q, low, last in blocks.get(dim, []):
                    most = bounds(q, c, *cells_of(cells, dim))[1]
                    at, of = np.nonzero(most >= low[:, None])
                    stay = (most[at, of] > low[at]) | (ids[of] <= last[at])
                    at, of = at[stay], of[stay]
                    yield pd.DataFrame({"query_id": query_ids[at], "class_id": ids[of], "high": most[at, of].astype(np.int64)})

    return file.mapInPandas(scan, "query_id long, class_id long, high long")


def searched(file: DataFrame, queries: DataFrame, cells: dict, k: int) -> DataFrame:
    """candidates() of all queries, in turns of SENT_BYTES of queries, each turn stored."""
    spark = file.sparkSession
    longest = queries.agg(F.max(F.size("v"))).first()[0] or 0
    blocks, number = query_blocks(queries, QUERY_BLOCK)
    blocks = stored(blocks, "query-blocks")
    each = max(1, SENT_BYTES // (QUERY_BLOCK * 8 * (longest + 1)))
    found = spark.createDataFrame([], "query_id long, class_id long, high long")
    for at in range(0, number, each):
        turn = blocks.where((F.col("q") >= at) & (F.col("q") < at + each)).select("dim", "ids", "vectors").collect()  # SENT_BYTES, or one block
        sent = spark.sparkContext.broadcast([r.asDict() for r in turn])
        reach = {r[0]: tuple(r[1]) for r in least_bounds(file, sent, cells, k).collect()}  # two numbers for each query of the turn
        found = found.unionByName(stored(candidates(file, sent, reach, cells), "near"))
        sent.unpersist()
    return found


def score(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("long"), lambda s, x: s + x)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k greatest inner products of each query with vectors, ties to the smaller vec_id.

    vectors and queries: vec_id and v, whole numbers. A query's own id is no result; vectors of another length are none
    either. A query with fewer candidates than k gets them all. Ids must be unique, as a row of the query's own id is left out.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    found = stored(classes(vectors, k + 1), "classes")
    queries = stored(queries, "queries")
    cells = ranges(found)
    file = stored(approximations(found, cells), "va-file")
    near = searched(file, queries, cells, k + 1)  # one more: a query's own class may hold it alone
    by_high = Window.partitionBy("query_id").orderBy(F.col("high").desc(), "class_id")
    near = stored(near.withColumn("turn", F.row_number().over(by_high)), "turns")

    def exact(pairs: DataFrame) -> DataFrame:
        got = pairs.join(found.select("class_id", "v", "ids"), "class_id").join(queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("_q")), "query_id")
        return got.select("query_id", "class_id", "ids", score("v", "_q").alias("score"))

    first = stored(exact(near.where(F.col("turn") <= k + 1)), "first")
    sure = first.groupBy("query_id").agg(F.min("score").alias("_sure"))  # there are k + 1 scores of that or more, if there is a turn k + 2
    rest = exact(near.where(F.col("turn") > k + 1).join(sure, "query_id").where(F.col("high") >= F.col("_sure")).select("query_id", "class_id"))
    each = first.unionByName(rest).withColumn("vec_id", F.explode("ids")).where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_numbers(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(vectors, vectors.where(F.col("vec_id") % QUERIES_EVERY == 0))


SQL_OP7 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

QUERIES, SQL = {"op7_topk": op7_topk}, {"op7_topk": SQL_OP7}
