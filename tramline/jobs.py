"""Command line of the jobs: ``python -m tramline <job> --help``, or through spark-submit."""

from __future__ import annotations

import argparse
from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from tramline.functions import new_load_number
from tramline.operators.fact import BOUND_SECONDS
from tramline.operators.skew import ROWS_PER_TASK
from tramline.plans.audit import audit_rows
from tramline.plans.fact import append_fact, backfill_fact
from tramline.plans.incremental import update_warehouse
from tramline.plans.static import load_static, write_silver_dims
from tramline.plans.warehouse import build_warehouse
from tramline.session import DELTA_CONF, get_session, stream_session
from tramline.sources.static import read_schedule_file
from tramline.sources.tables import FIFTEEN_SECONDS, TWO_MINUTES, UNTIL_DRAINED, read_table, write_table
from tramline.streaming import jobs as streams


class BatchCounts:
    """Rows read by a stream, added up while it runs.

    A query remembers its last hundred batches only, so they are taken over as they appear. Should more
    than that go by between two looks, their numbers are missing here and ``missed`` says how many.
    """

    def __init__(self) -> None:
        self.batches = self.rows = self.missed = 0
        self._last: int | None = None

    def add(self, progress: Iterable[dict]) -> None:
        """Take over what is new; a batch without rows may be reported more than once."""
        for step in progress:
            number = step["batchId"]
            if self._last is not None and number <= self._last:
                continue
            self.missed += max(0, number - self._last - 1) if self._last is not None else 0
            self._last = number
            self.batches += 1
            self.rows += step["numInputRows"]
            if step["numInputRows"]:
                print(f"batch {number}: {step['numInputRows']} rows read, {self.rows} in all", flush=True)


def _finish(query: StreamingQuery, every: float = 0.5) -> BatchCounts:
    """Wait for a query, reporting each batch while it runs, and all of them at its end."""
    counts = BatchCounts()
    try:
        while not query.awaitTermination(every):
            counts.add(query.recentProgress)
    finally:
        counts.add(query.recentProgress)
        missed = f", {counts.missed} more not counted" if counts.missed else ""
        print(f"{counts.batches} batches, {counts.rows} rows read{missed}", flush=True)
    return counts


def _options(args: argparse.Namespace) -> dict[str, str]:
    return dict(option.split("=", 1) for option in args.source_option)


def _publish(spark: SparkSession, args: argparse.Namespace) -> None:
    _finish(
        streams.publish_feed(
            spark,
            args.snapshots,
            args.part,
            args.topic,
            args.checkpoint,
            args.topic_format,
            args.servers,
            UNTIL_DRAINED if args.once else FIFTEEN_SECONDS,
        )
    )


def _bronze(spark: SparkSession, args: argparse.Namespace) -> None:
    start = {"bronze-positions": streams.bronze_positions, "bronze-updates": streams.bronze_updates}[args.job]
    _finish(
        start(
            spark,
            args.topic,
            args.path,
            args.checkpoint,
            args.topic_format,
            args.servers,
            args.format,
            UNTIL_DRAINED if args.once else TWO_MINUTES,
            _options(args),
            partition_by=args.partition_by,
        )
    )


def _load_static(spark: SparkSession, args: argparse.Namespace) -> None:
    runs = []
    try:
        load_static(spark, args.files, args.bronze, new_load_number(), multi_line=args.multi_line, runs=runs)
    finally:
        for run in runs:
            print(f"{run.layer}: {run.status}, {run.row_count} rows, load {run.load_number}")
        if args.audit:
            write_table(audit_rows(spark, runs), args.audit, mode="append")


def _silver_dims(spark: SparkSession, args: argparse.Namespace) -> None:
    write_silver_dims(spark, args.bronze, args.silver, args.format)


def _silver_fact(spark: SparkSession, args: argparse.Namespace) -> None:
    _finish(
        streams.silver_fact(
            stream_session(spark, args.state_partitions),
            f"{args.bronze}/vehicle_positions",
            f"{args.bronze}/trip_updates",
            f"{args.silver}/fact",
            args.checkpoint,
            args.format,
            UNTIL_DRAINED if args.once else None,
            args.bound,
            args.rows_per_task,
            _options(args),
            resent=args.resent,
        )
    )


def _backfill_fact(spark: SparkSession, args: argparse.Namespace) -> None:
    bound = None if args.unbounded else args.bound
    load = backfill_fact if args.replace else append_fact
    load(spark, args.bronze, args.silver, bound, args.format, args.first_day, args.last_day)


def _warehouse(spark: SparkSession, args: argparse.Namespace) -> None:
    stop_times = read_schedule_file(spark, args.stop_times) if args.stop_times else None
    holidays = read_table(spark, args.holidays) if args.holidays else None
    if args.update:
        update_warehouse(spark, args.bronze, args.target, None, stop_times, holidays, args.zone)
        return
    build_warehouse(
        spark, args.bronze, args.target, fmt=args.format, stop_times=stop_times, holidays=holidays, zone=args.zone
    )


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tramline")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, run, *required: str) -> argparse.ArgumentParser:
        command = jobs.add_parser(name)
        command.set_defaults(run=run)
        command.add_argument("--format", default="parquet", help="table format, such as parquet or delta")
        for option in required:
            command.add_argument(f"--{option}", required=True)
        return command

    def stream(name: str, run, *required: str) -> argparse.ArgumentParser:
        command = job(name, run, *required, "checkpoint")
        command.add_argument("--once", action="store_true", help="stop when the input is drained")
        command.add_argument("--source-option", action="append", default=[], metavar="NAME=VALUE")
        return command

    def topic(command: argparse.ArgumentParser) -> argparse.ArgumentParser:
        command.add_argument("--topic-format", default="kafka", help="kafka, or a file format with the topic a folder")
        command.add_argument("--servers", help="bootstrap servers of the message queue")
        return command

    publish = topic(stream("publish-feed", _publish, "snapshots", "topic"))
    publish.add_argument("--part", required=True, choices=["vehicle_positions", "trip_updates"])
    for name in ("bronze-positions", "bronze-updates"):
        bronze = topic(stream(name, _bronze, "topic", "path"))
        bronze.add_argument("--partition-by", action="append", default=[], metavar="COLUMN", help="such as start_date")
    static = job("load-static", _load_static, "files", "bronze")
    static.add_argument("--multi-line", action="store_true", help="fields may hold line breaks")
    static.add_argument("--audit", help="table to append the run audit to")
    job("silver-dims", _silver_dims, "bronze", "silver")
    fact = stream("silver-fact", _silver_fact, "bronze", "silver")
    fact.add_argument("--bound", type=int, default=BOUND_SECONDS, help="seconds either way")
    fact.add_argument("--rows-per-task", type=int, default=ROWS_PER_TASK, help="split keys with more positions or more updates than this")
    fact.add_argument("--resent", action="store_true", help="keep updates that are sent again unchanged as one row of state")
    fact.add_argument("--state-partitions", type=int, help="fixed by the first run of a checkpoint")
    backfill = job("backfill-fact", _backfill_fact, "bronze", "silver")
    backfill.add_argument("--bound", type=int, default=BOUND_SECONDS, help="seconds either way")
    backfill.add_argument("--unbounded", action="store_true", help="match updates of any time")
    backfill.add_argument("--replace", action="store_true", help="replace the days in a table by day instead of appending")
    for day in ("--first-day", "--last-day"):
        backfill.add_argument(day, type=date.fromisoformat, metavar="YYYY-MM-DD", help="UTC day of positions, included")
    star = job("warehouse", _warehouse, "bronze", "target")
    star.add_argument("--stop-times", help="schedule file with the planned arrivals")
    star.add_argument("--holidays", help="table with a date_id per holiday")
    star.add_argument("--update", action="store_true", help="take in new bronze files only, and keep dimension history")
    star.add_argument("--zone", default="UTC", help="time zone of the schedule")
    return top


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = get_session(f"tramline {args.job}", DELTA_CONF if args.format == "delta" else None)
    spark.sparkContext.setLogLevel("WARN")
    args.run(spark, args)
