"""Batch form of the fact pipeline."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions.times import FIRST_SECOND, LAST_SECOND
from tramline.operators.fact import BOUND_SECONDS, build_fact
from tramline.schemas import FACT, ddl
from tramline.sources.commits import CommitLog, new_run, remove_folder
from tramline.sources.tables import read_table, write_table


def second_of(day: date) -> int:
    """The first second of a UTC day."""
    return int(datetime.combine(day, time(), timezone.utc).timestamp())


def fact_of_days(
    positions: DataFrame, updates: DataFrame, bound: int, first: date | None = None, last: date | None = None
) -> DataFrame:
    """The fact rows of positions between two UTC days, both included, and only the updates they can meet.

    The tests are on stored columns, so files and row groups of other days are not read. Positions
    without a time belong to no day. Without days it is the whole fact.
    """
    if first is not None or last is not None:
        positions = positions.filter(F.col("vehicle_timestamp").between(FIRST_SECOND, LAST_SECOND))
    if first is not None:
        start = second_of(first)
        positions = positions.filter(F.col("vehicle_timestamp") >= start)
        updates = updates.filter(F.col("ingested_at") >= F.timestamp_seconds(F.lit(start - bound)))
    if last is not None:
        end = second_of(last + timedelta(days=1))
        positions = positions.filter(F.col("vehicle_timestamp") < end)
        updates = updates.filter(F.col("ingested_at") <= F.timestamp_seconds(F.lit(end + bound)))
    return build_fact(positions, updates, bound)


def append_fact(
    spark: SparkSession,
    bronze_dir: str,
    silver_dir: str,
    bound: int | None = BOUND_SECONDS,
    fmt: str = "parquet",
    first: date | None = None,
    last: date | None = None,
) -> None:
    """Append the fact rows of two bronze tables; use it for a backfill, not next to a stream.

    Whole tables, unless days are given. Without a bound a position meets updates of any time, so days
    need one.
    """
    if bound is None and (first or last):
        raise ValueError("days need a bound")
    positions = read_table(spark, f"{bronze_dir}/vehicle_positions", fmt)
    updates = read_table(spark, f"{bronze_dir}/trip_updates", fmt)
    days = first is not None or last is not None
    rows = fact_of_days(positions, updates, bound, first, last) if days else build_fact(positions, updates, bound)
    write_table(rows, f"{silver_dir}/fact", fmt, mode="append")


class DayTable:
    """The batch fact by UTC day of the position, in which a run replaces the days it names.

    A run writes its rows aside and commits one record with its days; of each day the last committed run
    counts. So the same backfill again, or one after a break, gives the rows of one. Positions without a
    time, and those of no day in a run of all days, make up a day of their own.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.log = CommitLog(spark, f"{path}/log")

    def replace(self, rows: DataFrame, days: list[date] | None, label: str) -> None:
        """Make ``rows`` the only ones of ``days``; without days, of the whole table."""
        run = new_run(label)
        dated = rows.withColumn("day", F.to_date("vehicle_timestamp"))
        if days is not None:
            dated = dated.filter(F.col("day").isin(days))
        # A day's rows go to few files; adaptive execution cuts up a day too large for one task.
        dated.hint("rebalance", "day").write.partitionBy("day").parquet(f"{self.path}/data/run={run}")
        if days is None:
            self.log.commit(run, [], self.log.runs())
        else:
            self.log.commit(run, [day.isoformat() for day in days])

    def _parts(self) -> tuple[str | None, dict[str, str]]:
        """The run that gave the whole table, if any, and the last run of each day named since (a row per day)."""
        records = {row["run"]: row["items"] for row in self.log.records().select("run", "items").collect()}
        base, owner = None, {}
        for run in self.log.runs():
            if records[run]:
                owner.update(dict.fromkeys(records[run], run))
            else:
                base = run
        return base, owner

    def read(self) -> DataFrame:
        """The fact rows that count. Which folders hold them is decided on partition columns alone."""
        base, owner = self._parts()
        if base is None and not owner:
            return self.spark.createDataFrame([], ddl(FACT))
        stored = read_table(self.spark, f"{self.path}/data", columns={**FACT, "day": "date", "run": "string"})
        own = F.concat_ws("/", "run", F.col("day").cast("string")).isin([f"{run}/{day}" for day, run in owner.items()])
        if base is not None:
            others = F.col("day").isNull() | ~F.col("day").cast("string").isin(list(owner))
            own = own | ((F.col("run") == base) & others)
        return stored.filter(own).select(*FACT)

    def drop_replaced(self) -> int:
        """Remove folders that no longer count, broken runs' included, for when no reader or writer is left."""
        base, owner = self._parts()
        stored = read_table(self.spark, f"{self.path}/data", columns={**FACT, "day": "date", "run": "string"})
        folders = {unquote(name).rpartition("/")[0] for name in stored.inputFiles()}
        gone = 0
        for folder in folders:
            run, day = (part.partition("=")[2] for part in folder.split("/")[-2:])
            counts = owner[day] == run if day in owner else run == base
            gone += not counts and remove_folder(self.spark, folder)
        return gone


def backfill_fact(
    spark: SparkSession,
    bronze_dir: str,
    silver_dir: str,
    bound: int | None = BOUND_SECONDS,
    fmt: str = "parquet",
    first: date | None = None,
    last: date | None = None,
) -> DayTable:
    """Replace days of the batch fact under ``silver_dir`` by what bronze gives for them; both or no ends given.

    Unlike ``append_fact`` it can be run any number of times.
    """
    if (first is None) != (last is None):
        raise ValueError("give both days or none")
    if bound is None and first:
        raise ValueError("days need a bound")
    positions = read_table(spark, f"{bronze_dir}/vehicle_positions", fmt)
    updates = read_table(spark, f"{bronze_dir}/trip_updates", fmt)
    table = DayTable(spark, f"{silver_dir}/fact_by_day")
    if first is None:
        table.replace(build_fact(positions, updates, bound), None, "all")
    else:
        days = [first + timedelta(days=i) for i in range((last - first).days + 1)]
        table.replace(fact_of_days(positions, updates, bound, first, last), days, f"{first}")
    return table
