"""The delay fact kept up to date from new bronze files alone.

What a visit of a stop needs from bronze are a minimum, a sum, a count and the newest pair. These merge,
so each load stores those of its new files by service date, aside, and commits them together with the
names of the files. Then the dates that any uncommitted fact depends on are put together again from all
committed loads and replace their partitions. A load that breaks before its commit leaves nothing that is
read; one that breaks after it is finished by the next, as publishing a date twice gives the same rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions import from_epoch, has_keys, known_epoch, new_load_number
from tramline.operators.dims import newest_vehicles, seen_vehicles
from tramline.plans.audit import AuditedRun, audit_rows
from tramline.plans.dimensions import DimensionTable
from tramline.plans.warehouse import VISIT, by_date, delays, dim_date
from tramline.schemas import (
    BRONZE_TRIP_UPDATE,
    PREDICTION_STATE,
    STATIC_DIMS,
    VEHICLE_DIM,
    VEHICLE_POSITION,
    VEHICLE_STATE,
    VISIT_STATE,
    Columns,
    ddl,
)
from tramline.sources.commits import CommitLog, new_files, new_run
from tramline.sources.tables import read_table, write_table

# Loads that a date is put together from before they are merged into one.
LOADS = 32


def visit_states(positions: DataFrame) -> DataFrame:
    """Per visit: the first second the vehicle stood there, and sum and count of its known speeds."""
    at = known_epoch(F.col("vehicle_timestamp"))
    speed = F.nullif(F.col("speed"), F.lit(0.0).cast("float")).cast("double")
    return (
        positions.filter(has_keys())
        .groupBy(*VISIT, "vehicle_id")
        .agg(
            F.min(F.when(F.col("current_status") == "STOPPED_AT", at)).alias("first_stopped"),
            F.sum(speed).alias("speed_sum"),
            F.count(speed).alias("speed_count"),
        )
    )


def merged_visits(states: DataFrame) -> DataFrame:
    return states.groupBy(*VISIT, "vehicle_id").agg(
        F.min("first_stopped").alias("first_stopped"),
        F.sum("speed_sum").alias("speed_sum"),
        F.sum("speed_count").alias("speed_count"),
    )


def visits_of(states: DataFrame) -> DataFrame:
    """Visits as the whole-table plan makes them."""
    return states.select(
        *VISIT,
        "vehicle_id",
        from_epoch(F.col("first_stopped")).alias("actual_arrival"),
        (F.col("speed_sum") / F.nullif(F.col("speed_count"), F.lit(0))).alias("avg_speed_segment"),
    )


def prediction_states(updates: DataFrame) -> DataFrame:
    """Per visit the newest known prediction; of two in one feed the later arrival."""
    arrival = known_epoch(F.col("arrival_time"))
    known = updates.filter(has_keys()).withColumn("arrival", arrival).filter("arrival IS NOT NULL AND feed_timestamp IS NOT NULL")
    return merged_predictions(known)


def merged_predictions(states: DataFrame) -> DataFrame:
    newest = F.max(F.struct("feed_timestamp", "arrival")).alias("newest")
    return states.groupBy(*VISIT).agg(newest).select(*VISIT, "newest.feed_timestamp", "newest.arrival")


def predictions_of(states: DataFrame) -> DataFrame:
    return states.select(*VISIT, from_epoch(F.col("arrival")).alias("estimated_arrival"))


def _of_dates(rows: DataFrame, dates: list[date | None]) -> DataFrame:
    """Rows of some dates; the test is on the partition column, so no other folder is read."""
    wanted = F.col("date_id").isin([day for day in dates if day is not None])
    return rows.filter(wanted | F.col("date_id").isNull() if None in dates else wanted)


class DelayTable:
    """The delay fact under ``star_dir`` with the states it is made from."""

    def __init__(self, spark: SparkSession, star_dir: str) -> None:
        self.spark = spark
        self.fact = f"{star_dir}/fact_stop_delay"
        self.state = f"{star_dir}/delay_state"
        self.loaded = CommitLog(spark, f"{self.state}/loaded")
        self.published = CommitLog(spark, f"{self.state}/published")

    def _write(self, rows: DataFrame, table: str, run: str, partition_by: tuple[str, ...] = ()) -> None:
        rows.write.partitionBy(*partition_by).parquet(f"{self.state}/{table}/run={run}")

    def _write_state(self, rows: DataFrame, table: str, run: str) -> None:
        dated = rows.withColumn("date_id", F.try_to_date("start_date", "yyyyMMdd"))
        self._write(dated.hint("rebalance", "date_id"), table, run, ("date_id",))

    def _states(self, table: str, columns: Columns, runs: list[str]) -> DataFrame:
        stored = read_table(self.spark, f"{self.state}/{table}", columns={**columns, "date_id": "date", "run": "string"})
        return stored.filter(F.col("run").isin(runs))

    def vehicles(self) -> DataFrame:
        """The newest attributes of every vehicle in committed loads."""
        return newest_vehicles(self._states("vehicles", VEHICLE_STATE, self.loaded.runs()))

    def service_days(self) -> DataFrame:
        """One row with the first and last service date of all visits."""
        dates = self._states("visits", VISIT_STATE, self.loaded.runs()).select("date_id")
        return dates.agg(F.min("date_id").alias("first"), F.max("date_id").alias("last"))

    def take_in(self, bronze_dir: str, load_number: str) -> int:
        """Store and commit the partial states of bronze files not seen before; returns their number."""
        tables = {"vehicle_positions": VEHICLE_POSITION, "trip_updates": BRONZE_TRIP_UPDATE}
        states = {"vehicle_positions": ("visits", visit_states), "trip_updates": ("predictions", prediction_states)}
        fresh = {
            table: new_files(read_table(self.spark, f"{bronze_dir}/{table}", columns=columns), self.loaded)
            for table, columns in tables.items()
        }
        seen = sum(fresh.values(), [])
        if not seen:
            return 0
        run = new_run(load_number)
        for table, columns in tables.items():
            # The base folder keeps columns that are laid out as folder names.
            reader = self.spark.read.schema(ddl(columns)).option("basePath", f"{bronze_dir}/{table}")
            rows = reader.parquet(*fresh[table]) if fresh[table] else self.spark.createDataFrame([], ddl(columns))
            name, of = states[table]
            self._write_state(of(rows), name, run)
            if table == "vehicle_positions":
                self._write(seen_vehicles(rows), "vehicles", run)
        self.loaded.commit(run, seen)
        return len(seen)

    def pending(self) -> tuple[list[str], list[date | None]]:
        """Committed loads not yet in the fact, and the dates they touch (a row per date)."""
        done = set(self.published.runs())
        runs = [run for run in self.loaded.runs() if run not in done]
        if not runs:
            return [], []
        dates = self._states("visits", VISIT_STATE, runs).select("date_id").union(
            self._states("predictions", PREDICTION_STATE, runs).select("date_id")
        )
        return runs, [row["date_id"] for row in dates.distinct().collect()]

    def delays_of(
        self, dates: list[date | None], stop_times: DataFrame | None, load_number: str, zone: str, ingested_at: Column | None
    ) -> DataFrame:
        """The fact rows of some dates from all committed loads."""
        runs = self.loaded.runs()
        visited = merged_visits(_of_dates(self._states("visits", VISIT_STATE, runs), dates))
        predicted = merged_predictions(_of_dates(self._states("predictions", PREDICTION_STATE, runs), dates))
        return delays(visits_of(visited), predictions_of(predicted), stop_times, load_number, zone, ingested_at)

    def publish(
        self, stop_times: DataFrame | None, load_number: str, zone: str = "UTC", ingested_at: Column | None = None
    ) -> list[date | None]:
        """Replace the fact's partitions of all pending dates; returns the dates."""
        _, dates = self.pending()
        if dates:
            self.publish_rows(by_date(self.delays_of(dates, stop_times, load_number, zone, ingested_at)))
        return dates

    def publish_rows(self, rows: DataFrame) -> None:
        """Replace the partitions of ``rows``, which are those of all pending dates, and commit that."""
        runs, _ = self.pending()
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("date_id").parquet(self.fact)
        for run in runs:
            self.published.commit(run)

    def merge_loads(self, load_number: str) -> None:
        """Put all committed loads together into one, so that a date is not read from ever more folders."""
        runs, (waiting, _) = self.loaded.runs(), self.pending()
        if waiting:
            raise ValueError("publish the pending dates first")
        run = new_run(f"{load_number}-merged")
        self._write_state(merged_visits(self._states("visits", VISIT_STATE, runs)), "visits", run)
        self._write_state(merged_predictions(self._states("predictions", PREDICTION_STATE, runs)), "predictions", run)
        seen = self._states("vehicles", VEHICLE_STATE, runs)
        self._write(seen.groupBy(*VEHICLE_DIM).agg(F.max("seen_at").alias("seen_at")), "vehicles", run)
        # If the run breaks between the two records, the next one publishes all dates once more.
        self.loaded.commit(run, replaces=runs)
        self.published.commit(run)


def load_delays(
    spark: SparkSession,
    bronze_dir: str,
    star_dir: str,
    stop_times: DataFrame | None = None,
    load_number: str | None = None,
    zone: str = "UTC",
    ingested_at: Column | None = None,
    loads: int = LOADS,
) -> list[date | None]:
    """Bring the delay fact up to date with bronze; returns the dates whose partitions were replaced.

    Reads the bronze files added since the last load, and the stored states of the dates these touch. The
    result is that of ``stop_delay`` over all of bronze, but for the stamps: a date carries those of the
    load that last touched it. A changed schedule does not touch dates by itself. Null or unreadable
    service dates share a partition. Without new files nothing changes.
    """
    load_number = load_number or new_load_number()
    table = DelayTable(spark, star_dir)
    table.take_in(bronze_dir, load_number)
    dates = table.publish(stop_times, load_number, zone, ingested_at)
    if len(table.loaded.runs()) > loads:
        table.merge_loads(load_number)
    return dates


def update_warehouse(
    spark: SparkSession,
    bronze_dir: str,
    target_dir: str,
    load_number: str | None = None,
    stop_times: DataFrame | None = None,
    holidays: DataFrame | None = None,
    zone: str = "UTC",
    now: Column | None = None,
) -> list[AuditedRun]:
    """Bring all star tables up to date: the fact by its touched dates, dimensions by merging into their history.

    The schedule's dimensions are complete in each load, so what they no longer hold is closed; a vehicle
    that is not seen again stays. Every replaced date and merged dimension is an audited run.
    """
    load_number = load_number or new_load_number()
    table = DelayTable(spark, target_dir)
    table.take_in(bronze_dir, load_number)
    if not table.loaded.runs():
        return []
    runs: list[AuditedRun] = []
    sources = {f"dim_{name}": read_table(spark, f"{bronze_dir}/dim_{name}") for name in STATIC_DIMS}
    sources["dim_vehicle"] = table.vehicles()
    try:
        for name, rows in sources.items():
            dim = DimensionTable(spark, target_dir, name)
            dim.merge(rows, load_number, now, complete=name != "dim_vehicle")
            audited(runs, load_number, name, dim.current(), f"{target_dir}/{name}")
        days = dim_date(F.min("first"), F.max("last"), table.service_days(), holidays)
        audited(runs, load_number, "dim_date", days, f"{target_dir}/dim_date")
        run = AuditedRun(load_number, "warehouse.fact_stop_delay")
        runs.append(run)
        dates = table.pending()[1]
        rows = by_date(table.delays_of(dates, stop_times, load_number, zone, now))
        run.write(rows, lambda counted: table.publish_rows(counted))
        if len(table.loaded.runs()) > LOADS:
            table.merge_loads(load_number)
    finally:
        write_table(audit_rows(spark, runs), f"{target_dir}/audit_pipeline_runs", mode="append")
    return runs


def audited(runs: list[AuditedRun], load_number: str, table: str, rows: DataFrame, path: str) -> None:
    """Replace a table as an audited run, which is added to ``runs`` first."""
    run = AuditedRun(load_number, f"warehouse.{table}")
    runs.append(run)
    run.write(rows, lambda counted: write_table(counted, path))
