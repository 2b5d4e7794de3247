"""Command line: python -m loomline.plans.cli --count 100000 --output-dir output --error-rate 0.15 --seed 2026 makes a bulk run.

With one of these words first it works on JSON Lines files instead: validate, stats, replay, convert, clean.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions.tables import written
from loomline.operators import repair, report, validate
from loomline.plans import generate
from loomline.sources import jsonl, records


def arguments(args: Sequence[str] | None = None) -> argparse.Namespace:
    # names and defaults are fixed values
    parser = argparse.ArgumentParser(prog="loomline", description="Generate tool-use trajectories")
    parser.add_argument("--count", type=int, default=100_000, help="rows")
    parser.add_argument("--output-dir", default="output", help="any folder that Spark can write to")
    parser.add_argument("--error-rate", type=float, default=0.15, help="above zero switches failures on, at 0.15")
    parser.add_argument("--seed", type=int, default=generate.SEED)
    parser.add_argument("--datasets", action="store_true", help="write the ten review datasets and their report instead")
    return parser.parse_args(args)


def run(spark: SparkSession, options: argparse.Namespace) -> list[str]:
    """Write the splits (or the review datasets); the lines of the report, of which there are a few for each dimension."""
    if options.datasets:
        generate.config_datasets_to_jsonl(spark, options.output_dir)
        return []
    generate.bulk_to_jsonl(spark, options.output_dir, options.count, options.seed, options.error_rate)
    drawn = generate.bulk_draws(spark, options.count, options.seed, options.error_rate).select("dataset", "id", "language", "tool_name", "difficulty")
    return report_lines(drawn)


def report_lines(rows: DataFrame) -> list[str]:
    lines = report.console(report.distribution(rows, ["language", "tool_name", "difficulty"])).select(F.concat_ws(" ", "dimension", "line").alias("line"))
    return [r["line"] for r in lines.collect()]


def file_arguments(args: Sequence[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="loomline", description="Work on JSON Lines files of trajectories")
    jobs = parser.add_subparsers(dest="job", required=True)
    for job, about in (("validate", "count valid and invalid records and lines that are none"), ("stats", "distributions"), ("replay", "some records, by a seeded draw"), ("convert", "the form that trainers read"), ("clean", "review and repair until nothing changes")):
        one = jobs.add_parser(job, help=about)
        one.add_argument("--input", required=True, help="files or a folder")
        if job in ("convert", "clean"):
            one.add_argument("--output", required=True, help="a folder, which is replaced")
        if job == "validate":
            one.add_argument("--bad-rows", help="a folder for a CSV of invalid records' ids and issues")
            one.add_argument("--comments", help="a folder for review comments as JSON Lines")
            one.add_argument("--rejects", help="a folder for the lines that are no records")
        if job == "replay":
            one.add_argument("--sample", type=int, default=5)
            one.add_argument("--seed", type=int, default=generate.SEED)
        if job == "clean":
            one.add_argument("--rounds", type=int, default=20)
    return parser.parse_args(args)


def named(found: DataFrame) -> DataFrame:
    """The good rows of records.scan() with id, the start of their line's sha256."""
    return found.where("reason IS NULL").withColumn("id", F.substring(F.sha2("line", 256), 1, 16))


def run_on_files(spark: SparkSession, options: argparse.Namespace) -> list[str]:
    """Do the job; a few lines that say what came of it."""
    found = written(records.scan(spark, options.input), "scan")
    rows = named(found)
    if options.job == "validate":
        issues = written(validate.structural_issues(rows.select("id", "messages")), "issues")
        stats = validate.batch_stats(issues).first()
        rejected = found.where("reason <> 'blank'")
        if options.bad_rows:
            jsonl.write_bad_rows(issues, options.bad_rows)
        if options.comments:
            jsonl.write_review_comments(validate.critique(rows.select("id", "messages")), options.comments)
        if options.rejects:
            rejected.select("file", "line", "reason").write.mode("overwrite").json(options.rejects)
        return [f"total {stats['total']}", f"valid {stats['valid']}", f"invalid {stats['invalid']}", f"rejected lines {rejected.count()}"]
    if options.job == "stats":
        about = rows.select(F.lit("files").alias("dataset"), "id", F.col("localization.language").alias("language"), F.col("metadata.tool_name").alias("tool_name"), F.col("metadata.difficulty").alias("difficulty"))
        return report_lines(about)
    if options.job == "replay":
        draw = F.md5(F.concat_ws("|", F.lit(str(options.seed)), "line").cast("binary"))
        return [r["line"] for r in rows.orderBy(draw, "line").limit(options.sample).select("line").collect()]
    if options.job == "convert":
        jsonl.training_form(rows).write.mode("overwrite").json(options.output)
        return [f"converted {rows.count()}"]
    done = written(repair.until_clean(rows.select("id", *jsonl.RECORD.names), options.rounds), "clean")
    done.select(*jsonl.RECORD.names, F.when(F.size("codes") > 0, F.col("codes")).alias("codes")).write.mode("overwrite").json(options.output)
    left = done.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("rounds") > 0).alias("changed"), F.count_if(F.size("codes") > 0).alias("left")).first()
    return [f"records {left['n']}", f"repaired {left['changed']}", f"with codes left {left['left']}"]


JOBS = ("validate", "stats", "replay", "convert", "clean")


def main(args: Sequence[str] | None = None) -> None:
    args = list(sys.argv[1:] if args is None else args)
    spark = SparkSession.builder.appName("loomline").getOrCreate()
    print("\n".join(run_on_files(spark, file_arguments(args)) if args and args[0] in JOBS else run(spark, arguments(args))))


if __name__ == "__main__":
    main()
