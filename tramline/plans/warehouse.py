"""The declared star schema, filled from bronze and silver tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions import clock_seconds, from_epoch, has_keys, known_epoch, new_load_number, service_time
from tramline.operators.dims import latest_vehicles
from tramline.operators.layout import laid_out
from tramline.operators.lookup import BROADCAST_ROWS, lookup, shuffled_lookup
from tramline.operators.quality import fk_orphans, pk_violations
from tramline.plans.audit import AuditedRun, audit_rows
from tramline.schemas import FOREIGN_KEYS, PRIMARY_KEYS, STATIC_DIMS, STOP_TIMES, WAREHOUSE, ddl
from tramline.session import work_root
from tramline.sources.tables import read_table, write_table

VISIT = ["start_date", "route_id", "trip_id", "stop_id"]


def conform(rows: DataFrame, table: str) -> DataFrame:
    """Declared columns in declared order and type.

    Columns nothing provides are null, and so are values the declared type cannot hold.
    """
    return rows.select(
        *(
            (F.col(name) if name in rows.columns else F.lit(None)).try_cast(kind).alias(name)
            for name, kind in WAREHOUSE[table].items()
        )
    )


def star_dim(dim: DataFrame, table: str, created_at: Column | None = None) -> DataFrame:
    """A silver static dimension with its creation stamp."""
    stamp = F.current_timestamp() if created_at is None else created_at
    return conform(dim.withColumn("created_at", stamp), table)


def dim_vehicle(positions: DataFrame, load_number: str, now: Column | None = None) -> DataFrame:
    """One row per vehicle id. Model and accessibility have no source and stay null."""
    stamp = F.current_timestamp() if now is None else now
    vehicles = latest_vehicles(positions).withColumns(
        {"created_at": stamp, "updated_at": stamp, "load_number": F.lit(load_number)}
    )
    return conform(vehicles, "dim_vehicle")


def dim_date(first: Column, last: Column, span: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """All days between two aggregates of ``span``, Monday being 1.

    ``holidays`` has one ``date_id`` per holiday; without it no day is one.
    """
    dates = span.agg(first.cast("date").alias("first"), last.cast("date").alias("last")).select(
        F.explode(F.sequence("first", "last")).alias("date_id")
    )
    day = F.weekday("date_id") + 1
    dates = dates.withColumns({"day_of_week": day, "is_weekend": day >= 6})
    if holidays is None:
        return conform(dates.withColumn("is_holiday", F.lit(False)), "dim_date")
    marked = holidays.select("date_id").distinct().withColumn("is_holiday", F.lit(True))
    return conform(dates.join(marked, "date_id", "left").na.fill(False, ["is_holiday"]), "dim_date")


def predictions(updates: DataFrame) -> DataFrame:
    """Latest known arrival prediction of each visit of a stop.

    Of two known predictions in one feed the later arrival counts, so the result does not depend
    on row order.
    """
    arrival = known_epoch(F.col("arrival_time"))
    order = F.col("feed_timestamp").cast("decimal(38,0)") * F.lit(10**13).cast("decimal(18,0)") + arrival
    return (
        updates.filter(has_keys())
        .groupBy(*VISIT)
        .agg(F.max_by(arrival, F.when(arrival.isNotNull(), order)).alias("estimated"))
        .select(*VISIT, from_epoch(F.col("estimated")).alias("estimated_arrival"))
    )


def visits(positions: DataFrame) -> DataFrame:
    """First time each vehicle stood at a stop on a service day, and its mean known speed there."""
    at = known_epoch(F.col("vehicle_timestamp"))
    stopped = F.min(F.when(F.col("current_status") == "STOPPED_AT", at))
    return (
        positions.filter(has_keys())
        .groupBy(*VISIT, "vehicle_id")
        .agg(
            from_epoch(stopped).alias("actual_arrival"),
            F.avg(F.nullif(F.col("speed"), F.lit(0.0).cast("float"))).alias("avg_speed_segment"),
        )
    )


def schedule(stop_times: DataFrame) -> DataFrame:
    """First scheduled arrival, in seconds of the service day, of each trip at each stop."""
    return stop_times.groupBy("trip_id", "stop_id").agg(
        F.min(clock_seconds(F.col("arrival_time"))).alias("scheduled_seconds")
    )


def stop_delay(
    positions: DataFrame,
    updates: DataFrame,
    stop_times: DataFrame | None,
    load_number: str,
    zone: str = "UTC",
    ingested_at: Column | None = None,
) -> DataFrame:
    """One row per vehicle and stop visit with scheduled, predicted and actual arrival.

    Both bronze tables shrink to one row per visit before they are joined. The delay is that of
    the actual arrival, else of the predicted one, and null without a schedule. The visits are
    stored first: the join measures them before it reads them, and the big scan should run once.

    The surrogate key is a hash of the natural key, the same on every run. Among some billions of
    visits two may collide, which the key checks show; the natural key stays exact.
    """
    return delays(visits(positions), predictions(updates), stop_times, load_number, zone, ingested_at)


def delays(
    visited: DataFrame,
    predicted: DataFrame,
    stop_times: DataFrame | None,
    load_number: str,
    zone: str = "UTC",
    ingested_at: Column | None = None,
) -> DataFrame:
    """The delay fact of visits and predictions, however they were put together."""
    work_root(visited.sparkSession)
    rows = shuffled_lookup(visited.checkpoint(), predicted, VISIT)
    if stop_times is None:
        stop_times = visited.sparkSession.createDataFrame([], ddl(STOP_TIMES))
    rows = lookup(rows, schedule(stop_times), ["trip_id", "stop_id"])
    date = F.try_to_date("start_date", "yyyyMMdd")
    rows = rows.withColumns(
        {"date_id": date, "scheduled_arrival": service_time(date, F.col("scheduled_seconds"), zone)}
    )
    reached = F.coalesce("actual_arrival", "estimated_arrival")
    return conform(
        rows.withColumns(
            {
                "fact_id": F.xxhash64(*VISIT, "vehicle_id"),
                "delay_seconds": F.unix_seconds(reached) - F.unix_seconds("scheduled_arrival"),
                "ingested_at": F.current_timestamp() if ingested_at is None else ingested_at,
                "load_number": F.lit(load_number),
            }
        ),
        "fact_stop_delay",
    )


def star_lookup(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows with the attributes of every given dimension, along its declared foreign key."""
    rows = fact
    for child, column, parent in FOREIGN_KEYS:
        if child == "fact_stop_delay" and parent in dims:
            dim = dims[parent]
            names = [name for name in dim.columns if name == column or name not in rows.columns]
            # All keys are the fact's own, so hot ones are looked for there, not above earlier lookups.
            rows = lookup(rows, dim.select(*names), [column], measured=fact.select(column))
    return rows


def key_checks(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every declared key over the given tables; an empty result means the key holds."""
    checks = {f"{table}.pk": pk_violations(rows, PRIMARY_KEYS[table]) for table, rows in tables.items()}
    for child, column, parent in FOREIGN_KEYS:
        if child in tables and parent in tables:
            checks[f"{child}.{column}"] = fk_orphans(tables[child], column, tables[parent])
    return checks


def create_tables(spark: SparkSession, database: str, fmt: str = "parquet") -> None:
    """Declare the empty star tables; the fact is laid out by date, its most common filter."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table, columns in WAREHOUSE.items():
        layout = "PARTITIONED BY (date_id)" if table == "fact_stop_delay" else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({ddl(columns)}) USING {fmt} {layout}")


def build_warehouse(
    spark: SparkSession,
    bronze_dir: str,
    target_dir: str,
    load_number: str | None = None,
    fmt: str = "parquet",
    stop_times: DataFrame | None = None,
    holidays: DataFrame | None = None,
    zone: str = "UTC",
    runs: list[AuditedRun] | None = None,
    save: Callable[[DataFrame, str], None] | None = None,
) -> list[AuditedRun]:
    """Replace all star tables from bronze and append one audit row per table.

    ``save(rows, table)`` may write the tables elsewhere, such as to a catalog or over JDBC.
    """
    if save is None:

        def save(rows: DataFrame, table: str) -> None:
            save_table(rows, f"{target_dir}/{table}", table)

    load_number = load_number or new_load_number()
    positions = read_table(spark, f"{bronze_dir}/vehicle_positions", fmt)
    updates = read_table(spark, f"{bronze_dir}/trip_updates", fmt)
    day = F.try_to_date("start_date", "yyyyMMdd")
    tables = {
        f"dim_{name}": star_dim(read_table(spark, f"{bronze_dir}/dim_{name}"), f"dim_{name}") for name in STATIC_DIMS
    }
    tables["dim_vehicle"] = dim_vehicle(positions, load_number)
    tables["dim_date"] = dim_date(F.min(day), F.max(day), positions.filter(has_keys()), holidays)
    # Laid out before the audit counts the rows: a layout above the count would hide it from an empty write.
    tables["fact_stop_delay"] = by_date(stop_delay(positions, updates, stop_times, load_number, zone))
    runs = [] if runs is None else runs
    try:
        for table, rows in tables.items():
            run = AuditedRun(load_number, f"warehouse.{table}")
            runs.append(run)
            run.write(rows, lambda counted, table=table: save(counted, table))
    finally:
        write_table(audit_rows(spark, runs), f"{target_dir}/audit_pipeline_runs", mode="append")
    return runs


def by_date(fact: DataFrame) -> DataFrame:
    """Rebalancing puts a date's rows into few files; adaptive execution cuts up a date that holds
    too many rows for one task."""
    return fact.hint("rebalance", "date_id")


def save_table(rows: DataFrame, path: str, table: str) -> None:
    """Write a star table as files, the fact in a folder per date."""
    write_table(rows, path, partition_by=["date_id"] if table == "fact_stop_delay" else ())


def insert_rows(rows: DataFrame, database: str, table: str) -> None:
    """Append to a declared catalog table, columns matched by name."""
    target = f"{database}.{table}"
    conform(rows, table).select(*rows.sparkSession.table(target).columns).write.insertInto(target)


# Rows of a fact file whose layout is meant for skipping: enough for long column chunks, few enough to be skipped.
ROWS_PER_FILE = 2_000_000


def save_for_filters(
    fact: DataFrame, path: str, columns: Sequence[str] = ("route_id", "date_id"), rows_per_file: int = ROWS_PER_FILE
) -> int:
    """Write the fact in an order that serves filters on any of its indexed columns; returns the number of files.

    Every file and row group then holds narrow ranges of all the columns, which Spark compares with a filter
    before it reads them. ``fact`` should be stored already.
    """
    files = max(1, -(-fact.count() // rows_per_file))
    laid_out(fact, columns, files).write.mode("overwrite").parquet(path)
    return files


def store_bucketed(rows: DataFrame, table: str, key: str, buckets: int) -> None:
    """Replace a catalog table cut and sorted by a key, so that joins on it need no shuffle.

    Its number of buckets is for good, and the same for all tables joined on the key: about one per 1 GB of
    the largest. A key with very many rows makes one large bucket; look those up by ``star_lookup``.
    """
    writer = rows.repartition(buckets, key).write.mode("overwrite").format("parquet")
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def bucketed_lookup(
    fact: DataFrame, dims: dict[str, DataFrame], key: str, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """``star_lookup`` of a fact stored in buckets by ``key``, with the dimension of that key stored alike.

    That dimension, which is too large to broadcast, is merged bucket by bucket; the others are broadcast
    once measured to be small, which leaves the fact's buckets as they are. So no row of the fact is
    shuffled. A further dimension that is too large falls back to a lookup that shuffles.
    """
    rows = fact
    for child, column, parent in FOREIGN_KEYS:
        if child != "fact_stop_delay" or parent not in dims:
            continue
        names = [name for name in dims[parent].columns if name == column or name not in rows.columns]
        dim = dims[parent].select(*names)
        if column == key:
            rows = rows.join(dim.hint("merge"), column, "left")
        else:
            rows = lookup(rows, dim, [column], broadcast_rows, measured=fact.select(column))
    return rows
