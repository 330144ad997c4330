"""The contract of the output files, checked on their raw lines."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.sources.shared import stored

# The headers of the two files.
MATCHING_HEADER, CANDIDATE_HEADER = ("source1_entity_id", "matched_entity_ids"), ("source1_entity_id", "candidate_entity_ids")
EXAMPLES, PARTS = 5, 256
#: Known ids that go to all tasks at most.
KNOWN = 1_000_000
#: Bytes of both files whose lists are brought together at once, and how often the files are read for that at most.
TOGETHER, PASSES = 32 << 20, 6


@dataclass
class Report:
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)

    @property
    def exit_code(self) -> int:
        return int(bool(self.errors))


def header_problem(line: str | None, expected: tuple[str, str]) -> str | None:
    """What is wrong with a first line; None if nothing is."""
    if not line:
        return "the file is empty"
    if "\t" not in line and "," in line:
        return "the header has commas and no tab: columns must be separated by tabs"
    found = tuple(c.strip().lower() for c in line.split("\t"))
    return None if found == expected else f"unexpected header {list(found)}, expected {list(expected)}"


def _s1() -> Column:
    return F.split("value", "\t")[0]


def _ids() -> Column:
    rest = F.regexp_replace("value", r"^[^\t]*\t", "")
    return F.when(F.trim(F.regexp_replace(rest, r"\s+", " ")) == "", F.array().cast("array<string>")).otherwise(F.split(rest, ",", -1))


def parsed(lines: DataFrame) -> DataFrame:
    """s1, ids (in order, empty ones kept) of the lines (column value) of a body that hold a tab, and at where lines are numbered."""
    return lines.where(F.col("value").contains("\t")).select(_s1().alias("s1"), _ids().alias("ids"), *(["at"] if "at" in lines.columns else []))


def violations(lines: DataFrame, required: DataFrame, valid_ids: DataFrame | None = None) -> DataFrame:
    """rule, offender: each different offender of each rule. required and valid_ids have entity_id.

    not_utf8 (by line, its bad bytes replaced), no_tab, duplicate_row, repeated_id (by query), self_match, wrong_prefix, unknown_id (only with valid_ids), missing_row,
    extra_row. An id that breaks the prefix rules is not looked up.
    """
    of = lambda rule, df, column: df.select(F.lit(rule).alias("rule"), F.col(column).alias("offender")).distinct()
    found = lambda rule, c: F.struct(F.lit(rule).alias("rule"), c.alias("offender"))
    tab, ids = F.col("value").contains("\t"), F.col("ids")
    prefix = lambda c: F.substring(c, 1, 3)
    # What a line shows by itself, from one reading of all lines.
    by_line = F.array(
        F.when(~F.is_valid_utf8("value"), found("not_utf8", F.make_valid_utf8("value"))), F.when(~tab & (F.trim("value") != ""), found("no_tab", F.col("value"))),
        F.when(F.size(ids) != F.size(F.array_distinct(ids)), found("repeated_id", F.col("s1"))),
    )
    bad = F.filter(ids, lambda x: ~prefix(x).isin("S2-", "S3-"))
    by_id = F.transform(bad, lambda x: F.when(prefix(x) == "S1-", found("self_match", x)).otherwise(found("wrong_prefix", x)))
    parts = lines.select("value", F.when(tab, _s1()).alias("s1"), F.when(tab, _ids()).otherwise(F.array().cast("array<string>")).alias("ids"))
    parts = stored(parts.select("s1", F.filter(F.array_distinct(F.concat(by_line, by_id)), lambda x: x.isNotNull()).alias("found")), "lines")
    rows = parts.where(F.col("s1").isNotNull()).select(F.col("s1").alias("entity_id"))
    need = required.select("entity_id")
    out = [
        parts.select(F.explode("found").alias("found")).select("found.rule", "found.offender").distinct(),
        of("duplicate_row", rows.groupBy("entity_id").count().where("count > 1"), "entity_id"),
        of("missing_row", need.join(rows, "entity_id", "left_anti"), "entity_id"),
        of("extra_row", rows.join(need, "entity_id", "left_anti"), "entity_id"),
    ]
    if valid_ids is not None:
        known, each = valid_ids.select(F.col("entity_id").alias("id")), parsed(lines).select(F.explode("ids").alias("id")).where(prefix(F.col("id")).isin("S2-", "S3-"))
        # Up to a fixed number the known ids go to the lines; else the different ids of the lines go to them.
        few = known.limit(KNOWN + 1).count() <= KNOWN
        out.append(of("unknown_id", each.join(F.broadcast(known), "id", "left_anti") if few else each.distinct().join(known, "id", "left_anti"), "id"))
    got = out[0]
    for more in out[1:]:
        got = got.union(more)
    return got


def summary(found: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """rule, offenders, examples (the first few in order, joined by commas). Offenders of a rule are first cut to the examples of each of PARTS parts."""
    part = found.withColumn("_part", F.pmod(F.xxhash64("offender"), F.lit(PARTS)))
    part = part.withColumn("_n", F.row_number().over(Window.partitionBy("rule", "_part").orderBy("offender")))
    part = part.groupBy("rule", "_part").agg(F.count("*").alias("offenders"), F.collect_list(F.when(F.col("_n") <= examples, F.col("offender"))).alias("first"))
    first = F.slice(F.array_sort(F.flatten(F.collect_list("first"))), 1, examples)
    return part.groupBy("rule").agg(F.sum("offenders").alias("offenders"), F.array_join(first, ",").alias("examples"))


def last_lines(lines: DataFrame) -> DataFrame:
    """s1, ids of the last line of each query, from numbered lines (columns at, s1, ids)."""
    return lines.groupBy("s1").agg(F.max_by("ids", "at").alias("ids"))


def outside_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """s1 of lines whose matches are not all among its candidates; both as parsed(). Of several lines of a query the last counts, where lines are numbered (column at)."""
    each = lambda df, name: (last_lines(df) if "at" in df.columns else df).select("s1", F.col("ids").alias(name))
    return lacking(each(matches, "_m").join(each(candidates, "_c"), "s1", "left"))


def outside_in_passes(matches: DataFrame, candidates: DataFrame, passes: int) -> DataFrame:
    """outside_candidates(), stored, of one share of the queries after the other, so that only the lists of one are shuffled at a time."""
    share = lambda df, n: df.where(F.pmod(F.xxhash64("s1"), F.lit(passes)) == n)
    found = [stored(outside_candidates(share(matches, n), share(candidates, n)), "outside") for n in range(passes)]
    return reduce(DataFrame.union, found)


def lacking(lines: DataFrame) -> DataFrame:
    """s1 of lines (s1, _m, _c) whose matches _m are not all among the candidates _c, null for none."""
    return lines.where(F.size(F.array_except("_m", F.coalesce("_c", F.array().cast("array<string>")))) > 0).select("s1")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, at: the lines of a file or of the files of a folder by name, at in their order: the file's place and the line's within it.

    Files are read whole lines at a time in pieces; a piece's number and its lines' ids grow along a file, and files are ordered by name.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_from"), F.monotonically_increasing_id().alias("_id"))
    return lines.select("value", F.struct("_file", "_from", "_id").alias("at"))


def _body(spark: SparkSession, path: str, expected: tuple[str, str]) -> tuple[str | None, DataFrame | None]:
    """The problem of a file's header, or its lines after it; only its first line is its header."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
        return "file not found", None
    lines = numbered_lines(spark, path)
    first = lines.agg(F.min("at").alias("at"), F.min_by("value", "at").alias("value")).first()
    problem = header_problem(first["value"], expected)
    return problem, None if problem else lines.where(F.col("at") > F.struct(*[F.lit(x).alias(n) for n, x in first["at"].asDict().items()]))


def _length(spark: SparkSession, path: str) -> int:
    """Bytes of a file or folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def validate_files(spark: SparkSession, matching: str, candidate: str | None, source1: DataFrame, valid_ids: DataFrame | None = None) -> Report:
    """A report on both files. A missing candidate file, matches outside candidates, and unchecked ids are warnings; all else is an error."""
    report, bodies = Report(), {}
    if valid_ids is None:
        report.warnings.append("ids are not looked up in the pool; give valid_ids for that")
    for name, path, expected in (("matches", matching, MATCHING_HEADER), ("candidates", candidate, CANDIDATE_HEADER)):
        if path is None:
            continue
        problem, body = _body(spark, path, expected)
        if problem:
            (report.warnings if name == "candidates" and problem == "file not found" else report.errors).append(f"{path}: {problem}")
            continue
        bodies[name] = parsed(body)
        for row in summary(violations(body, source1, valid_ids)).orderBy("rule").collect():  # a row for each rule
            report.errors.append(f"{path}: {row['rule']}: {row['offenders']} in all, such as {row['examples']}")
    if len(bodies) == 2:
        size = sum(_length(spark, path) for path in (matching, candidate))
        off = outside_in_passes(bodies["matches"], bodies["candidates"], min(PASSES, 1 + size // TOGETHER))
        n = off.count()
        if n:
            report.warnings.append(f"{n} queries have matches that are no candidates, such as {','.join(r[0] for r in off.orderBy('s1').limit(EXAMPLES).collect())}")
    return report
