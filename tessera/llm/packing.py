"""Best-fit packing of token sequences.

The lengths of all pieces are counted; the configuration linear program over that histogram (how often is each pattern of
lengths used) is solved by multiplicative weights, a knapsack dynamic program over the current prices giving the next
pattern. The solution is rounded: patterns that leave no more room than a round tolerates are used as often as whole pieces
are there, and the program is solved again for what is left, with more tolerance each time; the last few pieces are packed
best fit decreasing. The histogram has no more entries than the capacity, so the driver's work does not grow with the input;
the pieces find their sequence by their rank among pieces of equal length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import documents, small_batches, stored
from tessera.llm.tokens import KEPT, TOKENIZER, CachedTokenizer

CAPACITY = 2048
END = 0
#: Pieces of one length are ranked in so many parts.
PARTS = 256
#: Room that a pattern may leave in each round of the program: for all pieces, then for what rounding leaves; any in the last.
TOLERATED = (0, 0, 0, 1, 2, 4, 16, 64, 256, 1 << 30)
#: Patterns in a row that leave more room, after which a round ends: few lengths are left that fill a sequence together.
MISSES = 40
#: First prices are lengths to these powers; the second is only tried where the first needs more sequences than GAP above their bound.
POWERS, GAP = (1.0, 1.1), 0.001
#: So few pieces are packed without a linear program.
FEW = 200

Pattern = tuple[tuple[int, int], ...]


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, kept: int = KEPT) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the ids of each whole text and END, cut only where they are more than capacity.

    A null text counts as empty and gives one piece, END alone. Each row of docs is cut by itself, also if its doc_id repeats.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = CachedTokenizer(tokenizer, kept)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            rows = []
            coded = tok.encode_all([text or "" for text in batch["text"].tolist()])
            for doc, ids in zip(batch["doc_id"].tolist(), coded, strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def knapsack(price: np.ndarray, lengths: np.ndarray, capacity: int) -> dict[int, int]:
    """The pattern of greatest price: how often each length occurs in it.

    Lengths of which one at most fits beside itself come last, all at once. The others are added one by one, by price for
    length; one that those before it make up for within its own length is left out, and the search ends when no remaining
    length can improve on what is found. Both leave the greatest price as it is.
    """
    big = np.flatnonzero(2 * lengths > capacity)
    small = np.flatnonzero(2 * lengths <= capacity)
    density = price / lengths
    small = small[np.lexsort((-lengths[small], -density[small]))]
    beside = np.append(capacity - lengths[big], capacity)  # the room beside each big length, or beside none
    worth = np.append(price[big], 0.0)
    best, at = np.zeros(capacity + 1), np.arange(capacity + 1)
    steps: list[tuple[int, np.ndarray]] = []  # a length, and the best before it
    tried = 0
    for i in small.tolist():
        length, p = int(lengths[i]), float(price[i])
        if p <= best[length] + 1e-12:
            continue
        if tried < 3 or tried % 4 == 0:
            most = density[i] * at + np.maximum.accumulate(best - density[i] * at)
            if (worth + best[beside]).max() >= (worth + most[beside]).max() - 1e-12:
                break
        tried += 1
        steps.append((i, best))
        best, n = best.copy(), 1
        while n * length <= capacity:  # n more of it, or not: 1, 2, 4 and so on make every number
            best[n * length :] = np.maximum(best[n * length :], best[: capacity + 1 - n * length] + n * p)
            n *= 2
    out: dict[int, int] = defaultdict(int)
    k = int((worth + best[beside]).argmax())
    c = int(beside[k])
    if k < len(big):
        out[int(big[k])] = 1
    for i, before in reversed(steps):
        length = int(lengths[i])
        turns = np.arange(c // length + 1)
        n = int((before[c - turns * length] + turns * price[i]).argmax())
        if n:
            out[i] = n
            c -= n * length
    return out


def fractional(lengths: np.ndarray, count: np.ndarray, capacity: int, tolerated: int, power: float = 1.0) -> list[tuple[dict[int, int], float]]:
    """Patterns and how often to use each, from multiplicative weights: a length's price falls as its pieces get covered.

    Goes on until every length is covered, or MISSES patterns in a row leave more room than is tolerated; these are left out.
    Each step covers all pieces of one length that is still priced, so there are no more steps than lengths and such misses.
    """
    covered, used, missed = np.zeros(len(lengths)), [], 0
    eta = np.log(len(lengths) + 1) / 2
    while missed < MISSES and len(need := np.flatnonzero(covered < count)):
        price = (lengths[need] / capacity) ** power * np.exp(-eta * covered[need] / count[need])
        pattern = {int(need[i]): a for i, a in knapsack(price, lengths[need], capacity).items()}
        at = np.fromiter(pattern, np.int64)
        a = np.fromiter(pattern.values(), np.float64)
        step = max(float(np.min((count[at] - covered[at]) / a)), 0.5)
        covered[at] += a * step
        if capacity - int(lengths[at] @ a) <= tolerated:
            used.append((pattern, step))
            missed = 0
        else:
            missed += 1
    return used


def best_fit(count: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit decreasing over a histogram; sequences that hold the same are kept as one entry with a number."""
    room: dict[int, dict[Pattern, int]] = defaultdict(dict)
    for length in sorted((k for k, n in count.items() if n), reverse=True):
        left = count[length]
        for r in sorted(k for k in room if k >= length):
            fits = r // length
            for pattern in list(room[r]):
                have = room[r][pattern]
                while left and have:
                    each, n = (fits, min(have, left // fits)) if left >= fits else (left, 1)
                    have, left = have - n, left - each * n
                    to = (*pattern, (length, each))
                    room[r - each * length][to] = room[r - each * length].get(to, 0) + n
                if have:
                    room[r][pattern] = have
                else:
                    del room[r][pattern]
                if not left:
                    break
            if not left:
                break
        fits = capacity // length
        if left // fits:
            room[capacity - fits * length][((length, fits),)] = left // fits
        if left % fits:
            room[capacity - (left % fits) * length][((length, left % fits),)] = 1
    return [(p, n) for by in room.values() for p, n in by.items() if n]


def program(count: dict[int, int], capacity: int = CAPACITY, power: float = 1.0) -> tuple[list[tuple[Pattern, int]], dict[int, int]]:
    """The rounded solutions of the configuration program, and the pieces by length that they leave."""
    left, out = {k: n for k, n in count.items() if n}, []
    for tolerated in TOLERATED:
        if sum(left.values()) < FEW:
            break
        lengths = np.array(sorted(left))
        for pattern, step in fractional(lengths, np.array([left[int(k)] for k in lengths], float), capacity, tolerated, power):
            items = {int(lengths[i]): a for i, a in pattern.items()}
            n = min([int(np.ceil(step)), *(left.get(k, 0) // a for k, a in items.items())])
            if n > 0:
                out.append((tuple(sorted(items.items(), reverse=True)), n))
                for k, a in items.items():
                    left[k] -= a * n
        left = {k: n for k, n in left.items() if n}
    return out, left


def sequences(patterns: list[tuple[Pattern, int]]) -> int:
    return sum(n for _, n in patterns)


def bound(count: dict[int, int], capacity: int = CAPACITY) -> int:
    """So many sequences are needed at least: for all tokens, and for the pieces of which no two fit together."""
    return max(-(-sum(k * n for k, n in count.items()) // capacity), sum(n for k, n in count.items() if 2 * k > capacity))


def packed(count: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Patterns of lengths with the number of sequences of each, which hold exactly the pieces that count has by length."""
    rest = {k: n for k, n in count.items() if n}
    full: list[tuple[Pattern, int]] = []
    if rest.get(capacity):
        full.append((((capacity, 1),), rest.pop(capacity)))
    best = None
    for power in POWERS:
        solved, left = program(rest, capacity, power)
        solved += best_fit(left, capacity)
        best = solved if best is None or sequences(solved) < sequences(best) else best
        if sequences(best) <= bound(rest, capacity) * (1 + GAP) + 1:
            break
    return full + best


def places(patterns: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int]]:
    """length, first rank, pieces in a sequence, first sequence, offset there: where the pieces of a length from that rank go."""
    rows, rank, sequence = [], defaultdict(int), 0
    for pattern, n in patterns:
        offset = 0
        for length, a in pattern:
            rows.append((length, rank[length], a, sequence, offset))
            rank[length] += a * n
            offset += a * length
        sequence += n
    return rows


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, kept: int = KEPT) -> DataFrame:
    """pieces(docs) with sequence_id and offset. kept: parts whose ids a worker remembers. Pieces that agree in length, doc_id, piece and checksum are interchangeable; no rows for an empty table."""
    spark = docs.sparkSession
    small_batches(spark)
    cut = stored(pieces(docs, capacity, tokenizer, kept).withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(PARTS)).cast("int")), "pieces")
    parts = cut.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    count = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # a row for each length, up to capacity
    by_length = defaultdict(list)
    for length, *place in places(packed(count, capacity)):
        by_length[length].append(tuple(place))
    table = spark.createDataFrame([(k, sorted(v)) for k, v in by_length.items()], "length long, _places array<struct<rank: long, each: int, sequence: long, offset: long>>")
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    first = parts.select("length", "_part", F.coalesce(before, F.lit(0)).alias("_first"))
    inside = F.row_number().over(Window.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = cut.withColumn("_inside", inside).join(first, ["length", "_part"]).withColumn("_rank", F.col("_first") + F.col("_inside") - 1)
    ranked = ranked.join(F.broadcast(table), "length")  # a row for each length, up to capacity
    ranked = ranked.withColumn("_at", F.element_at(F.filter("_places", lambda p: p["rank"] <= F.col("_rank")), -1))
    turn = F.col("_rank") - F.col("_at.rank")
    sequence = F.col("_at.sequence") + F.floor(turn / F.col("_at.each"))
    offset = F.col("_at.offset") + turn % F.col("_at.each") * F.col("length")
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", sequence.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


QUERIES, SQL = {"op10_packing": op10_packing}, {}
