"""The jobs from the command line, for ``spark-submit run_job.py JOB …``."""

from __future__ import annotations

import argparse
import dataclasses
import json
import re
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from lendmill.operators.metrics import METRIC_KEYS
from lendmill.plans import (
    call_report,
    run_call_snapshot,
    run_call_upsert,
    run_dashboard,
    run_flatten_batch,
    run_flatten_stream,
    run_loan_batch,
    run_publish,
)
from lendmill.plans.call_table import CALL_BUCKETS
from lendmill.plans.message_flow import EXTRACT_ROWS
from lendmill.schemas import CALLS, FLAT
from lendmill.sinks import read_keyed_table
from lendmill.sources import MessageDir, MessageSource, Topic, read_csv_dir, read_parquet_table

PREVIEW_ROWS = 10


def message_place(text: str, options_file: str | None) -> MessageSource:
    """``topic:NAME`` or a directory; connector options come from a JSON file, not the command line."""
    if not text.startswith("topic:"):
        return MessageDir(text)
    options = json.loads(Path(options_file).read_text()) if options_file else {}
    return Topic(text.removeprefix("topic:"), options)


def read_settings(path: str) -> dict[str, str]:
    """Spark settings of a properties file: a name and a value a line, ``#`` for remarks."""
    found = {}
    for line in Path(path).read_text().splitlines():
        if (line := line.strip()) and not line.startswith("#"):
            name, value = re.split(r"\s*[=:]\s*|\s+", line, maxsplit=1)
            found[name] = value
    return found


def show(df: DataFrame) -> None:
    df.printSchema()
    df.show(PREVIEW_ROWS, truncate=False)


def loan_batch(spark: SparkSession, args: argparse.Namespace) -> object:
    result = run_loan_batch(
        spark,
        args.input,
        args.output,
        args.report_date,
        keys=args.keys.split(","),
        clean_files=args.clean_files,
        aggregated_files=args.aggregated_files,
        schemes=args.schemes.split(",") if args.schemes else None,
        most_malformed=args.most_malformed,
    )
    if args.preview:
        show(read_parquet_table(spark, result.clean_path))
    return dataclasses.asdict(result)


def publish(spark: SparkSession, args: argparse.Namespace) -> object:
    rows = args.rows if args.table is None else read_parquet_table(spark, args.table, FLAT)
    run_publish(spark, message_place(args.sink, args.options_file), rows)
    return {"rows": args.rows, "table": args.table}


def flatten_batch(spark: SparkSession, args: argparse.Namespace) -> object:
    source = message_place(args.source, args.options_file)
    result = run_flatten_batch(spark, source, args.flat, args.extract, args.extract_rows)
    if args.preview:
        show(read_parquet_table(spark, args.flat, FLAT))
    return dataclasses.asdict(result)


def flatten_stream(spark: SparkSession, args: argparse.Namespace) -> object:
    source = message_place(args.source, args.options_file)
    result = run_flatten_stream(
        spark, source, args.flat, args.checkpoint, view=args.view, timeout=args.timeout
    )
    if args.preview:
        show(result)
    return {"rows": result.count(), "flat_path": args.flat}


def dashboard(spark: SparkSession, args: argparse.Namespace) -> object:
    return run_dashboard(spark, args.flat, args.output, args.score_width)


def call_upsert(spark: SparkSession, args: argparse.Namespace) -> object:
    batch = read_csv_dir(spark, args.batch, CALLS, lossless=args.lossless, multi_line=args.multi_line)
    order = args.order_by.split(",") if args.order_by else ()
    return {"rows": run_call_upsert(spark, args.table, batch, order, args.buckets)}


def call_queries(spark: SparkSession, args: argparse.Namespace) -> object:
    for frame in call_report(read_keyed_table(spark, args.table)).values():
        frame.show(truncate=False)
    return {"table": args.table}


def call_snapshot(spark: SparkSession, args: argparse.Namespace) -> object:
    run_call_snapshot(spark, args.table, args.csv, lossless=args.lossless)
    return {"csv": args.csv}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="run_job.py", description=__doc__)
    top.add_argument("--settings", help="properties file with Spark settings for the job")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name, run, *positional, help):
        sub = jobs.add_parser(name, help=help)
        for argument in positional:
            sub.add_argument(argument)
        sub.set_defaults(run=run)
        return sub

    sub = job("loan-batch", loan_batch, "input", "output", "report_date", help=run_loan_batch.__doc__)
    sub.add_argument("--keys", default=",".join(METRIC_KEYS))
    sub.add_argument("--clean-files", type=int)
    sub.add_argument("--aggregated-files", type=int)
    sub.add_argument("--schemes", help="allowed path schemes, e.g. s3a")
    sub.add_argument("--most-malformed", type=int, help="fail beyond so many lines that do not parse")
    sub.add_argument("--preview", action="store_true")

    sub = job("publish", publish, "sink", help=run_publish.__doc__)
    what = sub.add_mutually_exclusive_group(required=True)
    what.add_argument("--table", help="a flat table, a message for each row")
    what.add_argument("--rows", type=int, help="so many synthetic applications")
    sub.add_argument("--options-file")

    sub = job("flatten-batch", flatten_batch, "source", "flat", help=run_flatten_batch.__doc__)
    sub.add_argument("--extract")
    sub.add_argument("--extract-rows", type=int, default=EXTRACT_ROWS)
    sub.add_argument("--options-file")
    sub.add_argument("--preview", action="store_true")

    sub = job(
        "flatten-stream", flatten_stream, "source", "flat", "checkpoint", help=run_flatten_stream.__doc__
    )
    sub.add_argument("--view", default="flat_messages")
    sub.add_argument("--timeout", type=float)
    sub.add_argument("--options-file")
    sub.add_argument("--preview", action="store_true")

    sub = job("dashboard", dashboard, "flat", "output", help=run_dashboard.__doc__)
    sub.add_argument("--score-width", type=int, default=1)

    sub = job("call-upsert", call_upsert, "batch", "table", help=run_call_upsert.__doc__)
    sub.add_argument("--order-by", help="columns by which the last row of a repeated key wins")
    sub.add_argument("--buckets", type=int, default=CALL_BUCKETS)
    sub.add_argument("--lossless", action="store_true", help="the batch is a lossless snapshot")
    sub.add_argument("--multi-line", action="store_true", help="quoted fields may hold line breaks")
    job("call-report", call_queries, "table", help=call_report.__doc__)
    sub = job("call-snapshot", call_snapshot, "table", "csv", help=run_call_snapshot.__doc__)
    sub.add_argument("--lossless", action="store_true", help="escape line breaks, keep null apart")
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    settings = read_settings(args.settings) if args.settings else {}
    if spark is None:
        builder = SparkSession.builder.appName(f"lendmill-{args.job}").config(map=settings)
        spark = builder.getOrCreate()
        spark.sparkContext.setLogLevel("WARN")
    else:
        for name, value in settings.items():
            if spark.conf.isModifiable(name):
                spark.conf.set(name, value)
    print(json.dumps(args.run(spark, args)))
