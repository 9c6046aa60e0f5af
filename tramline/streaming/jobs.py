"""The long-running queries. Each function starts one and returns it; callers await termination."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tramline.functions import JOIN_KEYS, time_slot
from tramline.operators import feed, skew
from tramline.operators.fact import (
    BOUND_SECONDS,
    POSITION_COLUMNS,
    UPDATE_COLUMNS,
    clean_positions,
    clean_updates,
    in_reach,
    join_updates,
    slotted,
    within,
)
from tramline.operators.messages import decode, encode, stamp_ingest
from tramline.operators.resent import join_stretches, streamed_stretches
from tramline.schemas import BRONZE_TRIP_UPDATE, FACT, TRIP_UPDATE, VEHICLE_POSITION, ddl
from tramline.session import state_partitions
from tramline.sources.static import stream_snapshots
from tramline.sources.tables import FIFTEEN_SECONDS, TWO_MINUTES, append_stream, read_table, stream_table, with_source_row
from tramline.sources.topics import POSITIONS_OPTIONS, UPDATES_OPTIONS, read_topic

LATENESS_SECONDS = 300
LATENESS = f"{LATENESS_SECONDS} seconds"
SPLIT_COLUMNS = {"cell": "int", "left_parts": "int", "right_parts": "int"}


def publish_feed(
    spark: SparkSession,
    snapshots_dir: str,
    part: str,
    topic: str,
    checkpoint: str,
    fmt: str = "kafka",
    servers: str | None = None,
    trigger: dict | None = FIFTEEN_SECONDS,
) -> StreamingQuery:
    """Flatten arriving feed snapshots and send the records of one part to its topic.

    The part is ``vehicle_positions`` or ``trip_updates``.
    """
    flatten = {"vehicle_positions": feed.vehicle_positions, "trip_updates": feed.trip_updates}[part]
    messages = encode(flatten(stream_snapshots(spark, snapshots_dir)))
    writer = messages.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if fmt == "kafka":
        writer = writer.option("kafka.bootstrap.servers", servers).option("topic", topic)
    else:
        writer = writer.option("path", topic)
    return (writer.trigger(**trigger) if trigger else writer).start()


def bronze_positions(
    spark: SparkSession,
    topic: str,
    path: str,
    checkpoint: str,
    topic_fmt: str = "kafka",
    servers: str | None = None,
    fmt: str = "parquet",
    trigger: dict | None = TWO_MINUTES,
    options: dict | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """``options`` are further source options, such as a limit of offsets per batch.

    ``partition_by`` lays the table out in folders, such as one per ``start_date``.
    """
    messages = read_topic(spark, topic, topic_fmt, servers, POSITIONS_OPTIONS | (options or {}))
    return append_stream(decode(messages, VEHICLE_POSITION), path, checkpoint, fmt, trigger, partition_by).start()


def bronze_updates(
    spark: SparkSession,
    topic: str,
    path: str,
    checkpoint: str,
    topic_fmt: str = "kafka",
    servers: str | None = None,
    fmt: str = "parquet",
    trigger: dict | None = TWO_MINUTES,
    options: dict | None = None,
    ingest_clock: Column | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """``ingest_clock`` replaces the processing time when a recorded topic is replayed."""
    messages = read_topic(spark, topic, topic_fmt, servers, UPDATES_OPTIONS | (options or {}))
    records = stamp_ingest(decode(messages, TRIP_UPDATE), ingest_clock)
    return append_stream(records, path, checkpoint, fmt, trigger, partition_by).start()


def silver_fact(
    spark: SparkSession,
    positions_path: str,
    updates_path: str,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: dict | None = None,
    bound: int = BOUND_SECONDS,
    rows_per_task: int | None = skew.ROWS_PER_TASK,
    options: dict | None = None,
    split: DataFrame | None = None,
    resent: bool = False,
) -> StreamingQuery:
    """Join the two bronze streams; ``spark`` is best a ``stream_session``.

    ``resent`` as in ``stream_fact``; a checkpoint keeps to the choice it was started with.

    Unless ``rows_per_task`` is None, the bronze tables are measured once, before the first start,
    and hot keys are split between state partitions for the life of the checkpoint. A first start on
    empty tables has nothing to measure: a caller who knows the hot keys, from another deployment or
    from ``plan_stream_split`` over any history, passes their cells as ``split``.
    """
    positions = stream_table(spark, positions_path, VEHICLE_POSITION, fmt, options)
    updates = stream_table(spark, updates_path, BRONZE_TRIP_UPDATE, fmt, options)
    hot = None
    if rows_per_task is not None:
        hot = _frozen_split(spark, positions_path, updates_path, checkpoint, fmt, bound, rows_per_task, split)
    if hot is not None and fmt == "parquet":
        positions, updates = with_source_row(positions), with_source_row(updates)
    return append_stream(stream_fact(positions, updates, bound, hot, resent), path, checkpoint, fmt, trigger).start()


def stream_fact(
    positions: DataFrame,
    updates: DataFrame,
    bound: int = BOUND_SECONDS,
    hot: DataFrame | None = None,
    resent: bool = False,
) -> DataFrame:
    """Watermarked left outer join of two bronze streams.

    ``resent`` keeps equal updates of a stretch of one bound as one row of state, for feeds that repeat
    them; rows are then given out one stretch later, and an update is late only when its stretch is over.
    Split keys are joined poll by poll.

    A position without an event time can neither match nor ever be given up on, and would stay in
    the state for good, so it ends here, as does an update without one. Rows later than the
    watermark are dropped by Spark.

    The watermark moves between batches only, so a first batch over a stored history holds all of it. As in
    batch the time slot is part of the key, or every update would be held against its key's whole history;
    updates are copied to the slots they can reach.
    """
    left = clean_positions(positions).filter(F.col("vehicle_timestamp").isNotNull())
    right = clean_updates(updates).filter(F.col("ingested_at").isNotNull())
    if hot is None and resent:
        right = streamed_stretches(timed(right, [*JOIN_KEYS, *UPDATE_COLUMNS]), JOIN_KEYS, bound)
        left = slotted(timed(left, POSITION_COLUMNS), "vehicle_timestamp", bound)
        return join_stretches(left, in_reach(right, bound, "first", "last"), bound, [*JOIN_KEYS, "slot"], step_in_reach(bound))
    if hot is None:
        left, right = timed(left, POSITION_COLUMNS), timed(right, [*JOIN_KEYS, *UPDATE_COLUMNS])
        if bound is None:  # Spark refuses to start it: no position could ever be given up on
            return join_updates(left, right, None)
        left, right = slotted(left, "vehicle_timestamp", bound), in_reach(right, bound)
        return join_updates(left, right, bound, [*JOIN_KEYS, "slot"])

    # Re-sent rows differ in feed_timestamp, and stored copies in their place if the source tells
    # it, so the part comes from the whole bronze row.
    left = _with_part(left, hot, "left_parts", "left_part")
    right = _with_part(right, hot, "right_parts", "right_part")
    left = timed(left, [*POSITION_COLUMNS, "left_part", "right_parts"])
    right = timed(right, [*JOIN_KEYS, *UPDATE_COLUMNS, "right_part", "left_parts"])
    keys = [*JOIN_KEYS, "left_part"]
    if hot.filter("right_parts > 1").isEmpty():
        left = slotted(left, "vehicle_timestamp", bound)
        return join_updates(left, in_reach(_for_every_left_part(right), bound), bound, [*keys, "slot"])
    return both_sides_split(left, right, bound, keys)


def both_sides_split(left: DataFrame, right: DataFrame, bound: int, keys: list[str]) -> DataFrame:
    """The outer join with both sides split: every pair of parts meets in one task, and positions
    without a partner come from a second join with one row per key and step of one bound.

    A step is shorter than the reach of a position, so one of its updates is within the bound if its first
    or its last is; a position meets a few rows, however many updates there are. Copies go first, as
    that drops the same late updates as the join of the pairs; a step is given once it is over.
    """
    left, keys = slotted(left, "vehicle_timestamp", bound), [*keys, "slot"]
    pairs = (
        left.withColumn("right_part", skew.every_part("right_parts"))
        .join(in_reach(_for_every_left_part(right), bound), [*keys, "right_part"])
        .filter(within(bound))
    )
    moments = right.select(*JOIN_KEYS, "ingested_at", "left_parts").dropDuplicates([*JOIN_KEYS, "ingested_at"])
    steps = moments.groupBy(*JOIN_KEYS, F.window("ingested_at", f"{bound} seconds").alias("step")).agg(
        F.min("ingested_at").alias("first"), F.max("ingested_at").alias("last"), F.max("left_parts").alias("left_parts")
    )
    steps = steps.withColumn("held_at", F.window_time("step")).drop("step")
    seen = in_reach(_for_every_left_part(steps), bound, "first", "last").alias("seen")
    positions, at = left.alias("positions"), F.col("vehicle_timestamp")
    reach = F.expr(f"INTERVAL {bound} SECONDS")
    on = [F.col(f"positions.{key}") == F.col(f"seen.{key}") for key in keys]
    on += [F.col("first").between(at - reach, at + reach) | F.col("last").between(at - reach, at + reach)]
    on += [step_in_reach(bound)]
    lonely = positions.join(seen, reduce(and_, on), "left_outer").filter(F.col("first").isNull())
    no_update = [F.lit(None).cast(FACT[name]).alias(name) for name in UPDATE_COLUMNS]
    lonely = lonely.select(*(f"positions.{name}" for name in POSITION_COLUMNS), *no_update).select(*FACT)
    return pairs.select(*FACT).unionByName(lonely)


def step_in_reach(bound: int) -> Column:
    """Tells a stream's join when to forget rows: a step of one bound ends at ``held_at``, its updates are up
    to one bound before, and reach one further either way."""
    return F.expr(
        f"vehicle_timestamp BETWEEN held_at - INTERVAL {2 * bound + 1} SECONDS AND held_at + INTERVAL {bound + 1} SECONDS"
    )


def timed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The columns a join needs, watermarked on the event time among them."""
    time = "vehicle_timestamp" if "vehicle_timestamp" in columns else "ingested_at"
    return rows.select(*columns).withWatermark(time, LATENESS)


def _with_part(rows: DataFrame, hot: DataFrame, parts: str, part: str) -> DataFrame:
    """Part numbers of both sides, 1 where nothing is hot, and the row's own part."""
    marked = rows.withColumn("cell", skew.cell(JOIN_KEYS)).join(F.broadcast(hot), "cell", "left")
    marked = marked.withColumns({name: F.coalesce(name, F.lit(1)) for name in ("left_parts", "right_parts")})
    return marked.withColumn(part, F.pmod(F.xxhash64(*rows.columns), F.col(parts)).cast("int"))


def _for_every_left_part(rows: DataFrame) -> DataFrame:
    return rows.withColumn("left_part", skew.every_part("left_parts")).drop("left_parts")


def plan_stream_split(
    positions: DataFrame, updates: DataFrame, bound: int = BOUND_SECONDS, rows_per_task: int = skew.ROWS_PER_TASK
) -> DataFrame | None:
    """Hot cells (cell, left_parts, right_parts) of two bronze tables, or None.

    The state holds a key's rows for the bound and the lateness on either side, not its history, so rows
    are counted per cell and window of that length, and a cell is judged by its fullest window. How far it is
    cut depends on the state partitions of the session the tables are of.
    """
    width = 2 * (bound + LATENESS_SECONDS)
    left = clean_positions(positions).filter(F.col("vehicle_timestamp").isNotNull())
    right = clean_updates(updates).filter(F.col("ingested_at").isNotNull())
    left = left.withColumn("slot", time_slot(F.unix_micros("vehicle_timestamp"), width))
    right = right.withColumn("slot", time_slot(F.unix_micros("ingested_at"), width))
    counts = skew.stored(skew.window_counts(left, right, JOIN_KEYS, "slot"))
    return skew.plan_split(counts, rows_per_task, tasks=state_partitions(positions.sparkSession)).hot


def _frozen_split(
    spark: SparkSession,
    positions_path: str,
    updates_path: str,
    checkpoint: str,
    fmt: str,
    bound: int,
    rows_per_task: int,
    split: DataFrame | None,
) -> DataFrame | None:
    """Hot cells, stored next to the checkpoint: state written under one split must be read under it.

    A folder without its success marker is what an interrupted start left; no batch has run under it, so
    it is measured and written anew.
    """
    stored = f"{checkpoint.rstrip('/')}-split"
    if not _complete(spark, stored):
        if split is None:
            split = plan_stream_split(
                read_table(spark, positions_path, fmt, VEHICLE_POSITION),
                read_table(spark, updates_path, fmt, BRONZE_TRIP_UPDATE),
                bound,
                rows_per_task,
            )
        hot = spark.createDataFrame([], ddl(SPLIT_COLUMNS)) if split is None else split
        hot.select([F.col(name).cast(kind).alias(name) for name, kind in SPLIT_COLUMNS.items()]).write.mode(
            "overwrite"
        ).parquet(stored)
    hot = read_table(spark, stored, columns=SPLIT_COLUMNS)
    return None if hot.isEmpty() else hot


def _complete(spark: SparkSession, folder: str) -> bool:
    """Whether a write to the folder has ended."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
