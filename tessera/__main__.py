"""Runs over folders of tab-separated files: python -m tessera COMMAND.

    split      train_source1.tsv into a fitting and a validation part
    train      a model on a training folder; prints the threshold search
    infer      candidate_pairs and matching_results of a test folder, checked and zipped
    benchmark  train on a sample of queries, their partners and distractors; prints recall and the search
    audit      recall, retention, precision and F0.5 of a model on a training folder
    validate   two result files against a test folder; exit code 1 if a rule is broken
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from tessera.operators import assign, blocking, labels, metrics, model, validate
from tessera.plans import linkage
from tessera.sources import sinks, tables
from tessera.sources.shared import stored


def sides(spark: SparkSession, folder: str, mode: str = "") -> tuple[DataFrame, DataFrame, DataFrame | None]:
    got = tables.read_split(spark, folder, missing_words=mode in linkage.MISSING_WORDS)
    return got["source1"], tables.pool(got["source2"], got["source3"]), got.get("ground_truth")


def split(spark: SparkSession, args: argparse.Namespace) -> int:
    one, two = labels.split(sides(spark, args.data)[0])
    sinks.write_tsv(one, f"{args.out}/train_split")
    sinks.write_tsv(two, f"{args.out}/val_split")
    return 0


def train(spark: SparkSession, args: argparse.Namespace) -> int:
    config = linkage.configured(args.mode, trees=args.trees)
    made, threshold, search = linkage.train(config, *sides(spark, args.data, args.mode))
    model.save(made, threshold, args.model, spark)
    sinks.write_search(search, f"{args.out}/threshold_search")
    search.orderBy("threshold").show(100, False)
    for name, weight in model.importances(made):
        print(f"{name}: {weight:.4f}")
    return 0


def matched(spark: SparkSession, args: argparse.Namespace, queries: DataFrame, pool: DataFrame) -> tuple[DataFrame, DataFrame]:
    if args.mode == "C":
        return linkage.link(linkage.MODES["C"], queries, pool)
    made, threshold, _ = model.load(args.model, spark)
    return linkage.link(linkage.configured(args.mode, threshold=threshold), queries, pool, made)


def infer(spark: SparkSession, args: argparse.Namespace) -> int:
    queries, pool, _ = sides(spark, args.data, args.mode)
    candidates, matches = matched(spark, args, queries, pool)
    sinks.write_pairs(candidates, f"{args.out}/candidates")
    sinks.write_pairs(matches, f"{args.out}/predictions")
    matches = spark.read.parquet(f"{args.out}/predictions")
    sinks.write_lists(assign.collected(candidates, queries, "blocking_rank"), f"{args.out}/candidate_pairs.tsv", validate.CANDIDATE_HEADER)
    sinks.write_lists(assign.collected(matches, queries, "probability", False), f"{args.out}/matching_results.tsv", validate.MATCHING_HEADER)
    report = validate.validate_files(spark, f"{args.out}/matching_results.tsv", f"{args.out}/candidate_pairs.tsv", queries, pool)
    print(*report.errors, *report.warnings, sep="\n")
    for name, table, order in (("candidates", candidates, "blocking_rank"), ("matches", matches, "probability")):
        print(name, metrics.output_counts(assign.collected(table, queries, order)).first().asDict())
    if args.zip and not report.exit_code:
        sinks.package(args.zip, {f"output/{n}": f"{args.out}/{n}" for n in ("candidate_pairs.tsv", "matching_results.tsv")}, args.add)
    return report.exit_code


def benchmark(spark: SparkSession, args: argparse.Namespace) -> int:
    queries, pool, truth = sides(spark, args.data, args.mode)
    queries = labels.sample(queries, args.queries)
    truth = truth.join(queries.select(queries["entity_id"].alias("source1_entity_id")), "source1_entity_id", "left_semi")
    pool = labels.benchmark_pool(pool, truth, args.distractors)
    config = linkage.configured(args.mode, trees=args.trees)
    pairs = stored(linkage.candidates(config, queries, pool), "candidates")
    blocking.candidate_recall(pairs, truth).show(truncate=False)
    _, threshold, search = linkage.train(config, queries, pool, truth, 0.5)
    search.orderBy("threshold").show(100, False)
    print(f"threshold {threshold}")
    return 0


def audit(spark: SparkSession, args: argparse.Namespace) -> int:
    queries, pool, truth = sides(spark, args.data, args.mode)
    if truth is None:
        raise ValueError(f"{args.data} has no ground truth")
    candidates, matches = matched(spark, args, queries, pool)
    metrics.audit_summary(truth, candidates, metrics.predictions(matches, 0.0)).show(vertical=True)
    return 0


def check(spark: SparkSession, args: argparse.Namespace) -> int:
    queries, pool, _ = sides(spark, args.data)
    report = validate.validate_files(spark, args.matches, args.candidates, queries, pool if args.check_ids else None)
    print(*(f"error: {e}" for e in report.errors), *(f"warning: {w}" for w in report.warnings), sep="\n")
    return report.exit_code


COMMANDS = {"split": split, "train": train, "infer": infer, "benchmark": benchmark, "audit": audit, "validate": check}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser("tessera", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("--data", required=True, help="folder of the tables; its name tells test from train")
    parser.add_argument("--out", default="output")
    parser.add_argument("--mode", choices=linkage.MODES, default="A")
    parser.add_argument("--model", default="output/model")
    parser.add_argument("--trees", type=int)
    parser.add_argument("--queries", type=int, default=5000, help="of the benchmark")
    parser.add_argument("--distractors", type=int, default=labels.DISTRACTORS, help="of each source in the benchmark")
    parser.add_argument("--matches", default="output/matching_results.tsv")
    parser.add_argument("--candidates", default="output/candidate_pairs.tsv")
    parser.add_argument("--check-ids", action="store_true", help="also look ids up in the pool")
    parser.add_argument("--zip", help="a zip of both results")
    parser.add_argument("--add", nargs="*", default=[], help="local files and folders for the zip")
    args = parser.parse_args(argv)
    return COMMANDS[args.command](SparkSession.builder.appName("tessera").getOrCreate(), args)


if __name__ == "__main__":
    sys.exit(main())
