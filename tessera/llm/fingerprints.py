"""Canonical exact digests of documents, in DataFrame operations only.

Canonical form: compatibility composition (NFKC), letter case and white space folded. The digest is 128 bits of xxhash over
its bytes. Documents of equal digests are compared byte by byte; should two differ, they get digests that differ.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import documents, stored, text_or_empty

#: Rows that stand together when each is shown its successor, and parts at most.
PART_ROWS, PARTS = 4096, 1 << 16
#: Digests of several documents that are broadcast at most, of about 50 bytes each; beyond that no broadcast is used.
BROADCAST_ROWS = 200_000


def canonical(text: Column) -> Column:
    """NFKC by the JVM's ICU library, both foldings of case (so that a sharp s equals ss), white space runs as one blank, none at the ends."""
    compose = lambda c: F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(True))
    return F.trim(F.regexp_replace(compose(F.lower(F.upper(compose(text)))), r"(?U)\s+", " "))


def wide_hash(data: Column) -> Column:
    digits = lambda h: F.lpad(F.hex(h), 16, "0")
    return F.lower(F.concat(digits(F.xxhash64(data)), digits(F.xxhash64(F.lit("wide"), data))))


def parted(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """docs with _crc and _part, parts of about PART_ROWS rows that rise with id, null first, and checksum; and the parts that hold rows: _part, _least (its least id and checksum), _prev (the part before, the last before the first).

    Parts are cut at approximate quantiles of the ids. An id that fills several is one range of its own, cut by checksum, and
    so are null ids; without such ids no checksum is needed and _crc is 0.
    """
    rows, nulls = docs.agg(F.count("doc_id"), F.count_if(F.col("doc_id").isNull())).first()
    parts = max(1, min(PARTS, rows // PART_ROWS))
    quantiles = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(parts)], max(10_000, 4 * parts))).first()[0] or []
    heavy = {c: n for c, n in Counter(quantiles).items() if n > 1}
    cuts = sorted({*quantiles, *(c + 1 for c in heavy if c < (1 << 63) - 1)})
    nulls = -(-min(nulls, PARTS * PART_ROWS) // PART_ROWS)
    crc = F.crc32("text") if heavy or nulls > 1 else F.lit(0).cast("long")
    sub = lambda n: F.floor(F.col("_crc") * n / (1 << 32)).cast("int")
    upto = lambda ids: F.size(F.filter(ids, lambda x: x <= F.col("doc_id")))
    part = F.lit(nulls)
    if cuts:
        step = max(1, int(len(cuts) ** 0.5))
        groups = [cuts[i : i + step] for i in range(0, len(cuts), step)]
        group = F.greatest(upto(F.lit([g[0] for g in groups])), F.lit(1))
        part = part + (group - 1) * step + upto(F.element_at(F.array(*[F.lit(g) for g in groups]), group))
    if heavy:
        table = F.array(*[F.struct(F.lit(c).alias("id"), F.lit(n).alias("n")) for c, n in sorted(heavy.items())])
        part = part + F.aggregate(table, F.lit(0), lambda s, h: s + F.when(h["id"] < F.col("doc_id"), h["n"] - 1).when(h["id"] == F.col("doc_id"), sub(h["n"])).otherwise(0))
    docs = docs.withColumn("_crc", crc).withColumn("_part", F.when(F.col("doc_id").isNull(), sub(nulls)).otherwise(part).cast("int"))
    first = sorted(docs.groupBy("_part").agg(F.min(F.struct("doc_id", "_crc")).alias("least")).collect())  # a row for each part
    rows = [(r["_part"], tuple(r["least"]), first[i - 1]["_part"]) for i, r in enumerate(first)]
    kind = f"struct<doc_id: {docs.schema['doc_id'].dataType.simpleString()}, _crc: bigint>"
    return docs, docs.sparkSession.createDataFrame(rows, f"_part int, _least {kind}, _prev int")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text: of the document with the next greater id, ties by checksum, then text; after the last comes the first.

    A null id is less than any other. The first rows of each part are also put at the end of the part before, so one exchange
    by part brings each document and its successor together, without a sort of all rows.
    """
    rows, parts = parted(docs.select("doc_id", text_or_empty().alias("text")))
    rows = rows.join(F.broadcast(parts), "_part")  # 3 * PARTS rows at most
    begins = F.struct("doc_id", "_crc").eqNullSafe(F.col("_least"))
    also = F.array_compact(F.array(F.struct(F.col("_part").alias("part"), F.lit(0).alias("extra")), F.when(begins, F.struct(F.col("_prev").alias("part"), F.lit(1).alias("extra")))))
    rows = rows.withColumn("_in", F.explode(also)).select("doc_id", "text", F.col("_in.part").alias("_part"), F.col("_in.extra").alias("_extra"))
    order = Window.partitionBy("_part").orderBy("_extra", F.col("doc_id").asc_nulls_first(), F.crc32("text"), "text")
    return rows.withColumn("next_text", F.lead("text").over(order)).where("_extra = 0").select("doc_id", "text", "next_text")


def colliding(docs: DataFrame, found: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """digest of each group of docs with equal digests whose canonical bytes differ.

    The least and the greatest bytes of a group are compared; partial aggregation leaves at most two of each group in a task.
    """
    several = stored(found.groupBy("fingerprint").count().where("count > 1").select(F.col("fingerprint").alias("_several")), "several")
    rows = docs.select(canonical(text_or_empty()).alias("_bytes")).withColumn("fingerprint", digest(F.col("_bytes")))
    if several.count() <= BROADCAST_ROWS:
        rows = rows.join(F.broadcast(several), F.col("fingerprint") == F.col("_several"), "left_semi")
    ends = rows.groupBy("fingerprint").agg(F.min("_bytes").alias("_least"), F.max("_bytes").alias("_most"))
    return ends.where("_least <> _most").select("fingerprint")


def fingerprinted(docs: DataFrame, digest: Callable[[Column], Column] = wide_hash) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row of docs.

    The edited text has the last half of its code points (rounded down) replaced by the first as many of the next document,
    or by all of them where it has fewer. Likeness is 1 for equal canonical bytes, else 0. Null texts count as empty, repeated
    rows and ids one by one. An empty table gives no rows.
    """
    rows = with_next(docs)
    half = F.floor(F.length("text") / 2).cast("int")
    rows = rows.withColumns({"n_chars": F.length("text").cast("long"), "_edited": F.concat(F.substr("text", F.lit(1), F.length("text") - half), F.substr("next_text", F.lit(1), half))})
    rows = rows.withColumns({"_bytes": canonical(F.col("text")), "_edited_bytes": canonical(F.col("_edited")), "_next_bytes": canonical(F.col("next_text"))})
    same = F.col("_bytes") == F.col("_edited_bytes")
    rows = rows.select("doc_id", "text", "n_chars", F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"), digest(F.col("_bytes")).alias("fingerprint"), digest(F.col("_edited_bytes")).alias("_edited_print"), same.alias("_same"), (F.col("_bytes") == F.col("_next_bytes")).alias("_same_next"))
    edited = F.when(~F.col("_same") & (F.col("_edited_print") == F.col("fingerprint")), F.concat("_edited_print", F.lit("-edited"))).otherwise(F.col("_edited_print"))
    one = lambda c: F.when(F.col(c), 1.0).otherwise(0.0)
    found = stored(rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", edited.alias("edited_fingerprint"), one("_same").alias("near_edited"), one("_same_next").alias("near_next")), "prints")
    if colliding(docs, found, digest).isEmpty():
        return found
    # Some digest stands for different bytes: all are made longer by a second, cryptographic one.
    return fingerprinted(docs, lambda c: F.concat(digest(c), F.lit("-"), F.sha2(c.cast("binary"), 256)))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprinted(documents(spark, sf_dir))


QUERIES, SQL = {"op4_fingerprints": op4_fingerprints}, {}
