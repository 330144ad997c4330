"""Exact removal of repeated byte strings by suffix arrays.

A byte goes if it lies in a string of LENGTH bytes that also starts elsewhere. Sorting the suffixes of a whole corpus is out
of reach, and most of them repeat nothing; so anchors come first. In every window of LENGTH bytes the k-grams of least hash
are its anchors: equal windows have equal anchors at equal places. An anchor's context, the bytes of the windows it is the anchor of,
is judged by its hash: contexts that occur twice are repeated whole; anchors that occur once repeat nothing. What is left,
anchors with several different contexts, goes to suffix arrays: each shard holds the contexts of some anchors, sorts their
suffixes by Larsson-Sadakane refinement and reads common prefixes off by Kasai's method. The contexts of a very common anchor
fill several shards, whose sorted windows are merged by binary search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import documents, skew_join, small_batches, stored, with_rows
from tessera.llm.hashing import mixed

LENGTH, GRAM = 200, 32
#: A place in one number: q, then bytes to the left of it, then to the right, which are LENGTH at most.
SIDE_BITS, PLACE_BITS = 12, 24
#: Contexts are compared in strings that begin so many bytes apart.
STEP = 8
#: Contexts of a shard; an anchor with more of them fills several.
SHARD = 4000
#: Contexts that are sorted at once, more where one anchor has more.
PIECE = 1000
#: Contexts, of about 80 bytes each, and bytes of spans that are broadcast at most; beyond that the join shuffles.
BROADCAST_CONTEXTS, BROADCAST_BYTES = 400_000, 32 << 20
#: Bytes of text that are hashed at once.
BLOCK = 1 << 19

_B = np.uint64(0x9E3779B97F4A7C15)
_B_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_TABLES = np.random.default_rng(5).integers(1, 1 << 63, (2, 256), np.uint64)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, BLOCK + 1)
        for name, base in (("up", _B), ("down", _B_INVERSE)):
            out = np.full(size, base, np.uint64)
            out[0] = 1
            _powers[name] = np.cumprod(out)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_sums(raw: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sums of a byte's number times a power of its place; the difference of two, times a power, is the hash of what lies between."""
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(table[raw] * powers(len(raw) + 1)[0][: len(raw)], out=out[1:])
    return out


def sliding(values: np.ndarray, width: int, fold: np.ufunc, fill: int) -> np.ndarray:
    """fold over each width values in a row: block-wise running folds from both sides."""
    n = len(values)
    padded = np.full(-(-n // width) * width, fill, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    right = fold.accumulate(blocks, 1).ravel()
    left = np.ascontiguousarray(fold.accumulate(blocks[:, ::-1], 1)[:, ::-1]).ravel()
    return fold(left[: n - width + 1], right[width - 1 : n])


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> Iterator[dict[str, np.ndarray]]:
    """The anchors of all texts, some texts at a time: of (position in texts), q (place), anchor and context hashes, start and end of the context."""
    at = 0
    while at < len(texts):
        stop, total = at, 0
        while stop < len(texts) and (stop == at or total + len(texts[stop]) <= BLOCK):
            total += len(texts[stop])
            stop += 1
        if total >= length:
            sizes = np.array([len(t) for t in texts[at:stop]])
            last = np.cumsum(sizes)
            raw = np.frombuffer(b"".join(texts[at:stop]), np.uint8)
            _, down = powers(total + 1)
            sums = [prefix_sums(raw, table) for table in _TABLES]
            grams = mixed((sums[0][gram:] - sums[0][:-gram]) * down[: total + 1 - gram])
            width = length - gram + 1
            short = (grams >> np.uint64(32)).astype(np.uint32) | np.uint32(1)  # enough to order them; equal ones are all anchors
            least = sliding(short, width, np.minimum, (1 << 32) - 1)
            inside = np.arange(total - length + 1) + length <= np.repeat(last, sizes)[: total - length + 1]
            least[~inside] = 0
            edge = np.zeros(len(grams) + width - 1, np.uint32)
            edge[width - 1 : width - 1 + len(least)] = least
            q = np.flatnonzero(sliding(edge, width, np.maximum, 0) == short)
            of = np.searchsorted(last, q, "right")
            # Windows whose least gram an anchor is stand in a row; they are its own, and its context is what they cover.
            starts = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
            run = np.searchsorted(starts, q, "right") - 1
            while len(other := np.flatnonzero(least[starts[run]] != short[q])):
                run[other] -= 1
            start = np.maximum(starts[run], q - width + 1)
            end = np.minimum(np.append(starts[1:], len(least))[run] - 1, q) + length
            hashed = (sums[1][end] - sums[1][start]) * down[start]
            hashed = mixed(mixed(hashed + (q - start).astype(np.uint64)) + (end - q).astype(np.uint64))
            first = last[of] - sizes[of]
            yield {"of": of + at, "q": q - first, "anchor": grams[q].view(np.int64), "context": hashed.view(np.int64), "start": start - first, "end": end - first}
        at = stop


def suffix_array(raw: np.ndarray, end: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The positions of raw in the order of their suffixes, each suffix ending with its own text, after which a sign stands that is less than any byte and differs by text.

    end, text: of each position, where its text ends and its number. Larsson-Sadakane: ranks by the first 7 bytes, then of
    twice as many in each round, and only groups that are still equal are sorted again. A rank is the last place of its group.
    """
    n = len(raw)
    end, text = end.astype(np.int32), text.astype(np.int32)
    key = np.zeros(n, np.uint64)
    left = end - np.arange(n, dtype=np.int32)
    signs = np.concatenate([raw.astype(np.uint64) + np.uint64(1), np.zeros(7, np.uint64)])
    for j in range(7):
        key = key << np.uint64(9) | signs[j : n + j] * (left > j)
    order = np.argsort(key).astype(np.int32)
    ordered = key[order]
    new = np.flatnonzero(np.append(ordered[1:] != ordered[:-1], True)).astype(np.int32)
    rank = np.empty(n, np.int32)
    size = np.diff(np.append(np.int32(-1), new))
    rank[order] = np.repeat(new, size)
    unsorted = np.flatnonzero(np.repeat(size > 1, size)).astype(np.int32)
    h, texts = 7, int(text[-1]) + 1 if n else 0
    where = order[unsorted]
    group = rank[where]
    while len(unsorted):
        second = rank[np.minimum(where + np.int32(h), n - 1)]
        short = np.flatnonzero(left[where] <= h)
        second[short] = text[where[short]] - np.int32(texts)
        both = group.astype(np.int64) * (n + texts) + second
        again = np.argsort(both)
        where, both = where[again], both[again]
        order[unsorted] = where
        ends = np.flatnonzero(np.append(both[1:] != both[:-1], True))
        size = np.diff(np.append(-1, ends))
        group = np.repeat(unsorted[ends], size)
        rank[where] = group
        open_ = np.repeat(size > 1, size)
        unsorted, where, group = unsorted[open_], where[open_], group[open_]
        h *= 2
    return order


def common_prefixes(raw: np.ndarray, end: np.ndarray, first: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place in order, how long a prefix its suffix shares with the one before, both within their texts.

    Kasai: along a text, that length falls by one at most from each suffix to the next. All texts (starting at first) are
    walked at once, and what still grows is compared eight bytes at a time, then byte by byte.
    """
    n = len(raw)
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    before = np.full(n, -1, np.int32)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    words = np.zeros(n, np.uint64)
    for j in range(8):
        words = words << np.uint64(8) | padded[j : n + j]
    out = np.zeros(n, np.int32)
    end = end.astype(np.int32)
    at, h = first.astype(np.int32), np.zeros(len(first), np.int32)
    stop = end[first]
    while len(at):
        other = before[at]
        h = np.where(other < 0, 0, np.maximum(h - 1, 0))
        most = np.where(other < 0, 0, np.minimum(stop - at, end[other] - other))
        grow = np.flatnonzero(h + 8 <= most)
        while len(grow):
            grow = grow[words[at[grow] + h[grow]] == words[other[grow] + h[grow]]]
            h[grow] += 8
            grow = grow[h[grow] + 8 <= most[grow]]
        grow = np.flatnonzero(h < most)
        while len(grow):
            grow = grow[raw[at[grow] + h[grow]] == raw[other[grow] + h[grow]]]
            h[grow] += 1
            grow = grow[h[grow] < most[grow]]
        out[place[at]] = h
        at = at + 1
        keep = at < stop
        at, h, stop = at[keep], h[keep], stop[keep]
    return out


def comparable(rows: pd.DataFrame, length: int = LENGTH, gram: int = GRAM) -> pd.DataFrame:
    """The contexts of rows (columns anchor, bytes, row, start, q, many) that may share a window with another one of their anchor, cut to where it may lie.

    A window begins STEP bytes or less before one of the places that lie whole STEPs left of the anchor, so it holds the
    length - STEP bytes from there; contexts with nobody who is equal in any of these strings share none. Nor is anything
    asked of those that occur several times.
    """
    sizes = rows["bytes"].map(len).to_numpy()
    raw = np.frombuffer(b"".join(rows["bytes"]), np.uint8)
    last = np.cumsum(sizes)
    first = last - sizes
    at = first + (rows["q"] - rows["start"]).to_numpy()
    many = rows["many"].to_numpy(bool)
    anchor = rows["anchor"].to_numpy().view(np.uint64)
    nearest, farthest = np.full(len(rows), length), np.full(len(rows), -1)
    sums = prefix_sums(raw, _TABLES[0])
    _, down = powers(len(raw) + 1)
    for shift in range(0, length - gram + 1, STEP):
        begin = at - shift
        end = begin + length - STEP
        there = np.flatnonzero((begin >= first) & (end <= last))
        if len(there):
            hashed = (sums[end[there]] - sums[begin[there]]) * down[begin[there]]
            _, group = np.unique(mixed(hashed) + anchor[there], return_inverse=True)
            good = (np.bincount(group) > 1) & (np.bincount(group, ~many[there]) > 0)
            met = there[good[group]]
            nearest[met] = np.minimum(nearest[met], shift)
            farthest[met] = shift
    keep = np.flatnonzero(farthest >= 0)
    begin = np.maximum(first, at - farthest - STEP)[keep]
    end = np.minimum(last, at - nearest + length)[keep]
    data = raw.tobytes()
    return rows.iloc[keep].assign(bytes=[data[a:b] for a, b in zip(begin, end, strict=True)], start=rows["start"].to_numpy()[keep] + begin - first[keep])


def shard_windows(rows: pd.DataFrame, length: int = LENGTH) -> dict[str, np.ndarray]:
    """Of each window of length in the contexts (columns bytes, row, start, many): run (equal for equal windows), the row and place where it starts, repeated, many and its position in raw; and raw."""
    parts = [b for b in rows["bytes"]]
    sizes = np.array([len(p) for p in parts])
    raw = np.frombuffer(b"".join(parts), np.uint8)
    last = np.cumsum(sizes)
    text = np.repeat(np.arange(len(parts)), sizes)
    end, first = last[text], last - sizes
    order = suffix_array(raw, end, text)
    prefix = common_prefixes(raw, end, first, order)
    window = end[order] - order >= length
    run = np.cumsum(prefix < length)
    at, run = order[window], run[window]
    _, run = np.unique(run, return_inverse=True)
    of = text[at]
    row, place = rows["row"].to_numpy()[of], rows["start"].to_numpy()[of] + at - first[of]
    many = rows["many"].to_numpy(bool)[of]
    runs = int(run.max()) + 1 if len(run) else 0
    some = np.zeros(runs, bool)
    some[run[many]] = True
    one_row, one_place = np.zeros(runs, np.int64), np.zeros(runs, np.int64)
    one_row[run], one_place[run] = row, place
    differs = (one_row[run] != row) | (one_place[run] != place)
    some[run[differs]] = True
    return {"run": run, "row": row, "place": place, "repeated": some[run], "many": many, "at": at, "raw": raw}


def spans_of(row: np.ndarray, place: np.ndarray, length: int = LENGTH) -> pd.DataFrame:
    """row, start, end: what windows starting at those places cover, joined where they overlap or touch."""
    if not len(row):
        return pd.DataFrame({"row": [], "start": [], "end": []}).astype("int64")
    order = np.lexsort((place, row))
    row, place = row[order], place[order]
    new = np.append(True, (row[1:] != row[:-1]) | (place[1:] > place[:-1] + length))
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(row)) - 1
    return pd.DataFrame({"row": row[starts], "start": place[starts], "end": place[ends] + length})


def window_hashes(raw: np.ndarray, at: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    _, down = powers(len(raw) + 1)
    one, two = (prefix_sums(raw, table) for table in _TABLES)
    return mixed((one[at + length] - one[at]) * down[at]), mixed((two[at + length] - two[at]) * down[at])


def pieces_of(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """rows in pieces of PIECE or more, without cutting an anchor's contexts apart: as much is sorted at once as fits the processor's cache."""
    rows = rows.sort_values("anchor", kind="stable")
    anchor = rows["anchor"].to_numpy()
    new = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    at = 0
    while at < len(rows):
        later = new[new >= at + PIECE]
        end = int(later[0]) if len(later) else len(rows)
        yield rows.iloc[at:end]
        at = end


def shard_spans(key: tuple, rows: pd.DataFrame, slices: int) -> pd.DataFrame:
    """row, start, end of what is repeated within a shard. A shard of a very common anchor also gives, for slices of the hash range, its sorted windows (slice, windows)."""
    rows = rows if str(key[0]).startswith("part") else comparable(rows)
    if not len(rows):
        return pd.DataFrame({c: pd.array([], "Int64") for c in ("row", "start", "end", "slice")} | {"windows": []})
    spans = []
    for part in pieces_of(rows):
        found = shard_windows(part)
        good = found["repeated"] & ~found["many"]
        spans.append(spans_of(found["row"][good], found["place"][good]))
    out = pd.concat(spans)
    if str(key[0]).startswith("part"):
        _, one = np.unique(found["run"], return_index=True)
        # A window that is repeated here is known; it stands for all of its run. The others wait for their equals in other shards.
        w1, w2 = window_hashes(found["raw"], found["at"][one])
        table = np.stack([w1, w2, found["row"][one].view(np.uint64), found["place"][one].astype(np.uint64), found["repeated"][one].astype(np.uint64)], 1)
        table = table[np.lexsort((w2, w1))]
        cut = (table[:, 0].astype(np.float64) / 2.0**64 * slices).astype(np.int64).clip(0, slices - 1)
        bounds = np.searchsorted(cut, np.arange(slices + 1))
        more = [{"slice": i, "windows": table[bounds[i] : bounds[i + 1]].tobytes()} for i in range(slices) if bounds[i + 1] > bounds[i]]
        out = pd.concat([out, pd.DataFrame(more)])
    for column in ("row", "start", "end", "slice"):
        out[column] = out[column].astype("Int64") if column in out else pd.array([None] * len(out), "Int64")
    out["windows"] = out["windows"].where(out["windows"].notna(), None) if "windows" in out else None
    return out[["row", "start", "end", "slice", "windows"]]


def merged_spans(rows: pd.DataFrame) -> pd.DataFrame:
    """row, start, end of windows that stand in several shards: each shard's sorted windows are looked up in those merged so far by binary search."""
    merged = np.zeros((0, 5), np.uint64)
    for windows in rows["windows"]:
        table = np.frombuffer(windows, np.uint64).reshape(-1, 5).copy()
        at = np.searchsorted(merged[:, 0], table[:, 0])
        equal = (at < len(merged)) & (merged[np.minimum(at, len(merged) - 1), 0] == table[:, 0]) & (merged[np.minimum(at, len(merged) - 1), 1] == table[:, 1]) if len(merged) else np.zeros(len(table), bool)
        hit = np.flatnonzero(equal)
        other = at[hit]
        # The same place of the same document, in contexts of two anchors, is no repetition.
        apart = (merged[other, 2] != table[hit, 2]) | (merged[other, 3] != table[hit, 3]) | (merged[other, 4] > 0) | (table[hit, 4] > 0)
        merged[other[apart], 4] |= np.uint64(2)
        table[hit[apart], 4] |= np.uint64(2)
        # All are kept, next to their equals, so that each gets its answer; a later shard meets the first of them.
        merged = np.insert(merged, at, table, 0)
    if not len(merged):
        return spans_of(np.zeros(0), np.zeros(0))
    same = np.append(False, (merged[1:, 0] == merged[:-1, 0]) & (merged[1:, 1] == merged[:-1, 1]))
    group = np.cumsum(~same) - 1
    any_ = np.zeros(int(group[-1]) + 1, bool)
    any_[group[merged[:, 4] > 0]] = True
    good = any_[group] & (merged[:, 4] & np.uint64(1) == 0)
    return spans_of(merged[good, 2].view(np.int64), merged[good, 3].view(np.int64))


def contexts(rows: DataFrame) -> DataFrame:
    """row, place, anchor, context for each anchor of each row; place holds q, and how far the context reaches to both sides of it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            number = batch["row"].to_numpy()
            for found in anchors([t.encode("utf-8", "surrogatepass") for t in batch["text"]]):
                place = found["q"] << PLACE_BITS | (found["q"] - found["start"]) << SIDE_BITS | (found["end"] - found["q"])
                yield pd.DataFrame({"row": number[found["of"]], "place": place, "anchor": found["anchor"], "context": found["context"]})

    return rows.select("row", "text").mapInPandas(run, "row long, place long, anchor long, context long")


def placed(table: DataFrame) -> DataFrame:
    """table with q, start and end instead of place."""
    q, side = F.shiftright("place", PLACE_BITS), (1 << SIDE_BITS) - 1
    return table.withColumns({"q": q, "start": q - F.shiftright("place", SIDE_BITS).bitwiseAND(side), "end": q + F.col("place").bitwiseAND(side)}).drop("place")


def repeated_spans(rows: DataFrame) -> DataFrame:
    """row, start, end (byte places, possibly overlapping): all bytes in strings of LENGTH that also start elsewhere."""
    spark = rows.sparkSession
    small_batches(spark)
    found = stored(contexts(rows), "anchors")
    each = found.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.first("row").alias("row"), F.first("place").alias("place"))
    each = stored(each, "contexts")
    by_anchor = each.groupBy("anchor").agg(F.count("*").alias("different"), F.sum("n").alias("all")).where("all > 1")
    known = skew_join(each, stored(by_anchor.select("anchor", "different"), "anchors"), "anchor", "different").where("different is not null")
    known = placed(stored(known, "repeated"))

    # Contexts that occur several times are repeated whole, wherever they occur.
    many = known.where("n > 1").select("anchor", "context")
    whole = placed(found.join(many, ["anchor", "context"], "left_semi").select("row", "place")).select("row", "start", "end")

    # The others are compared with the different contexts of their anchor.
    asked = known.where(F.col("different") > 1).select("row", "anchor", "context", "start", "q", "end", (F.col("n") > 1).alias("many"), "different")
    asked = asked.withColumn("shards", F.ceil(F.col("different") / SHARD).cast("int"))
    size = asked.agg(F.count("*"), F.count_if(F.col("shards") > 1)).first()
    requests = asked.groupBy("row").agg(F.collect_list(F.struct("anchor", "context", "start", "q", "end", "many", "shards")).alias("asked"))
    requests = stored(requests, "requests")
    texts = rows.select("row", "text").join(F.broadcast(requests) if size[0] <= BROADCAST_CONTEXTS else requests, "row")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row, text, wanted in zip(batch["row"].tolist(), batch["text"], batch["asked"], strict=True):
                text = text.encode("utf-8", "surrogatepass")
                out += [(row, w["anchor"], w["context"], w["start"], w["q"], w["many"], w["shards"], text[w["start"] : w["end"]]) for w in wanted]
            yield pd.DataFrame(out, columns=["row", "anchor", "context", "start", "q", "many", "shards", "bytes"])

    pieces = texts.mapInPandas(cut, "row long, anchor long, context long, start long, q long, many boolean, shards int, bytes binary")
    usual = F.concat(F.lit("shard:"), F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-size[0] // SHARD)))).cast("string"))
    common = F.concat_ws(":", F.lit("part"), "anchor", F.pmod(F.xxhash64("context"), F.col("shards")))
    slices = max(1, -(-size[1] // SHARD))
    sharded = pieces.withColumn("shard", F.when(F.col("shards") == 1, usual).otherwise(common)).groupBy("shard")
    sorted_ = stored(sharded.applyInPandas(lambda key, part: shard_spans(key, part, slices), "row long, start long, end long, slice long, windows binary"), "shards")
    across = sorted_.where("slice is not null").select("slice", "windows").groupBy("slice").applyInPandas(merged_spans, "row long, start long, end long")
    return whole.unionByName(sorted_.where("slice is null").select("row", "start", "end")).unionByName(across)


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes) for each row of docs. Null texts count as empty; equal rows are each other's repetition."""
    rows = with_rows(docs)
    spans = repeated_spans(rows).groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def join_spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for spans in batch["spans"]:
                edges = np.array(sorted((s["start"], s["end"]) for s in spans), np.int64)
                reach = np.maximum.accumulate(edges[:, 1])
                new = np.append(True, edges[1:, 0] > reach[:-1])
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(edges)) - 1
                out.append(np.stack([edges[first, 0], reach[last]], 1).tobytes())
            yield pd.DataFrame({"row": batch["row"], "spans": out})

    spans = stored(spans.mapInPandas(join_spans, "row long, spans binary"), "spans")
    small = (spans.agg(F.sum(F.octet_length("spans") + 32)).first()[0] or 0) <= BROADCAST_BYTES

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, spans in zip(batch["text"], batch["spans"], strict=True):
                text = text.encode("utf-8", "surrogatepass")
                edges = np.frombuffer(spans, np.int64).reshape(-1, 2) if isinstance(spans, bytes) else np.zeros((0, 2), np.int64)
                left = np.append(0, edges[:, 1]).tolist()
                right = np.append(edges[:, 0], len(text)).tolist()
                out.append((len(text), int((edges[:, 1] - edges[:, 0]).sum()), len(edges), b"".join([text[a:b] for a, b in zip(left, right, strict=True)])))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), **{c: [o[i] for o in out] for i, c in enumerate(("n_bytes", "n_removed", "n_spans", "kept"))}})

    got = rows.join(F.broadcast(spans) if small else spans, "row", "left")
    return got.select(F.col("doc_id").cast("long"), "text", "spans").mapInPandas(keep, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = without_repeats(documents(spark, sf_dir))
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


SQL_OP6 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 400)) AS k FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199)) AS p FROM d)),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY k) AS n FROM w) WHERE n > 1),
g AS (SELECT doc_id, p, CASE WHEN p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 200 THEN 1 ELSE 0 END AS new FROM r),
i AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS i FROM g),
x AS (SELECT doc_id, min(p) AS a, max(p) + 200 AS b FROM i GROUP BY doc_id, i),
y AS (SELECT doc_id, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b, sum(b - a)::BIGINT AS gone, count(*) AS spans FROM x GROUP BY doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN spans IS NULL THEN h ELSE array_to_string(list_transform(range(1, len(a) + 2), lambda j:
    substr(h, CASE WHEN j = 1 THEN 1 ELSE 2 * b[j - 1] + 1 END, CASE WHEN j > len(a) THEN length(h) ELSE 2 * a[j] END - CASE WHEN j = 1 THEN 0 ELSE 2 * b[j - 1] END)), '') END)) AS kept_sha256
FROM d LEFT JOIN y USING (doc_id)
"""

QUERIES, SQL = {"op6_suffixes": op6_suffixes}, {"op6_suffixes": SQL_OP6}
