"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

The documents of each source stand in a shuffled queue, which starts again after its end. The j-th word of a source has the
virtual finish time j / target, a copy that of its last word. All words of all sources in the order of their finish times are
the mix, which is cut where it holds as many words as all documents together, so that each source has had what its target
says but for less than a word.

The cut is found without a sort of all words. Copies are counted by ranges of virtual time: those that end before the copies
begun so far fill the budget are in, those that begin after the copies ended so far have filled it are out. The words between
are range-sorted, counted by range, and cut within the range where the running total reaches the budget.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import documents, stored, text_or_empty, whole_row

WORD = r"[^\x20\x09-\x0D]+"
#: A document occurs in the mix so many times at most.
REPEATS = 3
#: Hexadecimal digits of the shuffle key by which the queue of a source is cut; 4096 pieces of each source.
CUT = 3
#: Ranges of a unit of virtual time, of which two units are told apart, and of the time in which the cut lies.
RANGES, FINE = 4096, 1024
SEED = "mix-1"


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def named(source: Column) -> Column:
    """A key for each source, of which null is one."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("null"))


def source_targets(sized: DataFrame) -> DataFrame:
    """source, source_size, target, from columns source and size. Weights are 1, 2, 3, repeating by code point, null last.

    A target is the weight times a common level, but no more than REPEATS times the source's size. The level falls on the
    sources below their limits: what those above leave over raises it, until no more are above. Sources are numbered by
    ranges, and only sums reach the driver.
    """
    total = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    last = F.col("source").asc_nulls_last()
    total = stored(total.orderBy(last).withColumn("_range", F.spark_partition_id()), "sources")
    held = dict(total.groupBy("_range").count().collect())  # a row for each range of the sort
    first = list(accumulate((held.get(i, 0) for i in range(max(held, default=0))), initial=0))
    place = F.element_at(F.lit(first), F.col("_range") + 1) + F.row_number().over(Window.partitionBy("_range").orderBy(last)) - 1
    total = stored(total.withColumn("_w", place % 3 + 1).withColumn("_ratio", REPEATS * F.col("source_size") / F.col("_w")), "weights")
    level, above = 0.0, None
    while True:
        over = F.col("_ratio") < level
        words, weights, out, out_w = total.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in (F.col("source_size"), F.col("_w"), F.when(over, REPEATS * F.col("source_size")), F.when(over, F.col("_w")))]).first()
        if out_w == above:
            break
        level, above = float(words - out) / (weights - out_w) if weights > out_w else 0.0, out_w
    return total.select("source", "source_size", F.when(F.col("_ratio") < level, (REPEATS * F.col("source_size")).cast("double")).otherwise(F.col("_w") * F.lit(level)).alias("target"))


def copies_of(queue: DataFrame) -> DataFrame:
    """queue with copy (from 0) and start (words that its source has served before it), a row for each copy."""
    got = queue.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(REPEATS - 1))))
    return got.withColumn("start", F.col("copy") * F.col("source_size") + F.col("queue_end") - F.col("size"))


def truncated(queue: DataFrame) -> DataFrame:
    """_source, upto: how many words of each source stand before the cut, from columns source, _source, size, source_size, target and queue_end of queue, a stored table."""
    budget = queue.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    copies = copies_of(queue.where("size > 0 and target > 0"))
    at = lambda words: F.least(F.floor(words / F.col("target") * RANGES), F.lit(2 * RANGES)).cast("int")
    copies = copies.withColumns({"_from": at(F.col("start")), "_to": at(F.col("start") + F.col("size"))})
    none = F.lit(0).cast("long")
    edges = F.explode(F.array(F.struct(F.col("_from").alias("at"), F.col("size").alias("begun"), none.alias("ended")), F.struct(F.col("_to").alias("at"), none.alias("begun"), F.col("size").alias("ended"))))
    sums = copies.select(edges.alias("_e")).select("_e.*").groupBy("at").agg(F.sum("begun").alias("begun"), F.sum("ended").alias("ended"))
    sums = {r["at"]: (r["begun"], r["ended"]) for r in sums.collect()}  # 2 * RANGES + 1 rows at most
    begun, ended = (list(accumulate((sums.get(i, (0, 0))[k] for i in range(2 * RANGES)), initial=0)) for k in (0, 1))
    low = max(i for i, n in enumerate(begun) if n <= budget)
    high = min((i for i, n in enumerate(ended) if n >= budget), default=2 * RANGES)
    before = F.floor(F.col("target") * (low / RANGES)).cast("long")
    # Copies whose words all end before, or begin after, need not be told apart by words.
    open_ = copies.where((F.col("_to") >= low) & (F.col("_from") <= high))
    first, last = F.greatest(F.col("start"), before) + 1, F.least(F.col("start") + F.col("size"), F.ceil(F.col("target") * (high / RANGES)).cast("long"))
    words_ = open_.withColumns({"_first": first, "_last": last}).where("_first <= _last").select("source", "_source", "target", F.explode(F.sequence("_first", "_last")).alias("word"))
    words_ = words_.withColumn("finish", F.col("word").cast("double") / F.col("target"))
    width = max(high - low, 1) / RANGES
    words_ = stored(words_.withColumn("range", F.least(F.greatest(F.floor((F.col("finish") - low / RANGES) / width * FINE), F.lit(0)), F.lit(FINE - 1)).cast("int")), "words")
    sources = stored(queue.groupBy("_source").agg(F.first("target").alias("target"), F.first("source_size").alias("source_size")).withColumn("_before", F.least(before, REPEATS * F.col("source_size"))), "sources")
    left = max(0, budget - (sources.agg(F.sum("_before")).first()[0] or 0))
    counts = dict(words_.groupBy("range").count().collect())  # FINE rows at most
    upto = list(accumulate((counts.get(i, 0) for i in range(FINE)), initial=0))
    cut = max(i for i, n in enumerate(upto) if n <= left)
    place = F.row_number().over(Window.partitionBy("range").orderBy("finish", F.col("source").asc_nulls_last(), "word"))
    within = words_.where(F.col("range") == cut).withColumn("_n", place).where(F.col("_n") <= left - upto[cut]).drop("_n")
    more = words_.where(F.col("range") < cut).unionByName(within).groupBy("_source").agg(F.count("*").alias("_more"))
    return sources.join(more, "_source", "left").select("_source", (F.col("_before") + F.coalesce("_more", F.lit(0))).alias("upto"))


def fair_queue(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, queue_end, virtual_finish, upto and the columns in keep, one row for each of docs.

    size: words of the text, none for null. queue_end: words that the source has served at the end of the first copy;
    virtual_finish: the virtual time then (null where a target is 0). upto: words of the source in the truncated mix; taken:
    those of the document, repeats counted. Equal doc_ids are ordered by checksum; rows that agree in both are
    interchangeable. A null source is a source of its own, null doc_ids are queued by their text. Empty documents take 0 words.
    """
    none = F.concat(F.lit("null:"), F.md5(text_or_empty().cast("binary")))
    key = F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col("doc_id").cast("string"), none)).cast("binary"))
    rows = docs.select("doc_id", "source", words(text_or_empty()).alias("size"), F.crc32(text_or_empty().cast("binary")).alias("_crc"), key.alias("_key"), *keep)
    rows = rows.withColumns({"_cut": F.substring("_key", 1, CUT), "_source": named(F.col("source"))})
    sized = stored(rows.drop(*keep), "sized")
    targets = source_targets(sized).withColumn("_source", named(F.col("source")))
    cuts = sized.groupBy("_source", "_cut").agg(F.sum("size").alias("_words"))
    before = F.sum("_words").over(Window.partitionBy("_source").orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1))
    cuts = stored(cuts.withColumn("_before", F.coalesce(before, F.lit(0))).join(targets.drop("source"), "_source").drop("_words"), "cuts")
    inside = F.sum("size").over(Window.partitionBy("_source", "_cut").orderBy("_key", "_crc").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    queued = lambda df: df.withColumn("_inside", inside).join(cuts, ["_source", "_cut"]).withColumn("queue_end", F.col("_before") + F.col("_inside"))
    narrow = stored(queued(sized), "queue")
    got = (queued(rows) if keep else narrow).join(truncated(narrow), "_source")
    served = [F.greatest(F.lit(0), F.least(F.col("size"), F.col("upto") - (e * F.col("source_size") + F.col("queue_end") - F.col("size")))) for e in range(REPEATS)]
    got = got.withColumns({"taken": sum(served[1:], served[0]).cast("long"), "virtual_finish": F.when(F.col("target") > 0, F.col("queue_end") / F.col("target"))})
    return got.select("doc_id", "source", "size", "source_size", "target", "taken", "queue_end", "virtual_finish", "upto", *keep)


def mix_order(queued: DataFrame) -> DataFrame:
    """The mix, from fair_queue: a row for each copy that has words before the cut, globally sorted by finish time. Adds copy, words (those before the cut) and copy_finish."""
    copies = copies_of(queued)
    copies = copies.withColumn("words", F.least(F.col("size"), F.col("upto") - F.col("start"))).where("words > 0")
    return copies.withColumn("copy_finish", (F.col("start") + F.col("size")) / F.col("target")).orderBy("copy_finish", "doc_id", "copy")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """docs in the order of the mix with docs' columns, each row as often as its copies are in it.

    Copies stay whole: one that the cut divides counts if half of its words stand before it, and documents without words,
    which use none of the budget, stay once.
    """
    rows = whole_row(docs).withColumn("source", F.col("_row.source"))
    copies = copies_of(fair_queue(rows, ("_row",)))
    served = 2 * (F.col("upto") - F.col("start")) >= F.col("size")
    copies = copies.where(F.when(F.col("size") > 0, served & (F.col("upto") > 0)).otherwise(F.col("copy") == 0))
    return copies.withColumn("_finish", (F.col("start") + F.col("size")) / F.greatest(F.col("target"), F.lit(1.0))).orderBy("_finish", "doc_id", "copy").select("_row.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_queue(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "virtual_finish")


SQL_OP9 = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, '')))) AS k FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS w FROM totals),
limits AS (SELECT *, 3 * source_size AS lim, (3 * source_size)::DOUBLE / w AS ratio FROM weighed),
sums AS (SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS total_w,
                sum(lim) OVER o - lim AS done, sum(w) OVER o - w AS done_w FROM limits
         WINDOW o AS (ORDER BY ratio, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
levels AS (SELECT *, (total - done)::DOUBLE / (total_w - done_w)::DOUBLE AS lvl FROM sums),
common AS (SELECT arg_min(lvl, (ratio, coalesce(source, chr(1114111)))) AS c FROM levels WHERE lvl <= ratio),
targets AS (SELECT source, source_size, CASE WHEN ratio < c THEN lim::DOUBLE ELSE w * c END AS target FROM levels, common),
queued AS (SELECT s.*, sum(size) OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING)::BIGINT AS e FROM sized s),
-- Every word of every source as a row, in the order of finish times; as many as there are words in all are the mix.
served AS (SELECT source, j, j::DOUBLE / target AS finish FROM (SELECT source, target, unnest(range(1, 3 * source_size + 1)) AS j FROM targets WHERE target > 0)),
mix AS (SELECT source, j FROM (SELECT *, row_number() OVER (ORDER BY finish, source NULLS LAST, j) AS n FROM served) WHERE n <= (SELECT sum(size) FROM sized)),
upto AS (SELECT source, count(*) AS u, max(j) AS m FROM mix GROUP BY source),
copies AS (SELECT q.source, q.doc_id, q.k, c * t.source_size + q.e - q.size AS a, c * t.source_size + q.e AS b FROM queued q JOIN targets t ON q.source IS NOT DISTINCT FROM t.source, (SELECT unnest([0, 1, 2]) AS c)),
taken AS (SELECT c.source, c.doc_id, c.k, sum(greatest(0, least(c.b, coalesce(u.u, 0)) - c.a))::BIGINT AS taken FROM copies c LEFT JOIN upto u ON c.source IS NOT DISTINCT FROM u.source GROUP BY ALL)
SELECT q.doc_id, q.size, t.source_size, t.target, n.taken, CASE WHEN t.target > 0 THEN q.e::DOUBLE / t.target END AS virtual_finish
FROM queued q JOIN targets t ON q.source IS NOT DISTINCT FROM t.source JOIN taken n ON n.k = q.k AND n.doc_id IS NOT DISTINCT FROM q.doc_id AND n.source IS NOT DISTINCT FROM q.source
"""

QUERIES, SQL = {"op9_mixing": op9_mixing}, {"op9_mixing": SQL_OP9}
