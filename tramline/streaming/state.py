"""What a stream's join still holds: rows waiting by side, key and time, read from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions import JOIN_KEYS
from tramline.operators.fact import BOUND_SECONDS, slot_of

EVENT_TIME = {"left": "vehicle_timestamp", "right": "ingested_at"}


def join_operators(spark: SparkSession, checkpoint: str) -> list[int]:
    """Numbers of the joins in a checkpoint's last batch, in order; a row per operator reaches the driver."""
    found = spark.read.format("state-metadata").load(checkpoint)
    rows = found.filter("operatorName = 'symmetricHashJoin'").select("operatorId").distinct().collect()
    return sorted(row["operatorId"] for row in rows)


def waiting_rows(
    spark: SparkSession, checkpoint: str, operator: int | None = None, bound: int = BOUND_SECONDS
) -> DataFrame:
    """side, the join keys, event_time, partition_id of every row the first (or given) join holds.

    ``left`` rows are positions that may still meet an update or have to be given up on, ``right`` ones
    updates that a position may still meet. Of an update's copies only that in its own slot is listed, hence the
    stream's ``bound``. Read by a task per state partition, with nothing running; the
    session needs the state store provider the stream has (``stream_session``).
    """
    operator = join_operators(spark, checkpoint)[0] if operator is None else operator
    sides = []
    for side, time in EVENT_TIME.items():
        state = spark.read.format("statestore").option("operatorId", operator).option("joinSide", side).load(checkpoint)
        held = {field.name for field in state.schema["value"].dataType}
        at = F.col(f"value.{time}") if time in held else F.col("value.last")
        if "slot" in held:  # a checkpoint begun without slots has none
            state = state.filter(F.col("value.slot") == slot_of(F.unix_micros(at), bound))
        keys = [F.col(f"value.{name}").alias(name) for name in JOIN_KEYS]
        sides.append(state.select(F.lit(side).alias("side"), *keys, at.alias("event_time"), "partition_id"))
    return sides[0].unionByName(sides[1])


def waiting_by_age(
    spark: SparkSession, checkpoint: str, seconds: int = 600, operator: int | None = None, bound: int = BOUND_SECONDS
) -> DataFrame:
    """side, start, row_count, key_count, oldest of each stretch of time the join still holds rows of."""
    start = F.window("event_time", f"{seconds} seconds")["start"].alias("start")
    return waiting_rows(spark, checkpoint, operator, bound).groupBy("side", start).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct(*JOIN_KEYS).alias("key_count"),
        F.min("event_time").alias("oldest"),
    )


def fullest_keys(
    spark: SparkSession, checkpoint: str, most: int = 20, operator: int | None = None, bound: int = BOUND_SECONDS
) -> DataFrame:
    """The keys with the most rows on either side, for finding those that have turned hot."""
    rows = waiting_rows(spark, checkpoint, operator, bound)
    counts = rows.groupBy("side", *JOIN_KEYS).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy(F.col("row_count").desc(), "side", *JOIN_KEYS).limit(most)
