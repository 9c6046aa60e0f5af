"""Vehicle positions joined with the arrival predictions around them.

A position is kept once per prediction of its trip, route and stop ingested within the bound,
both ends included, or once with nulls. Every re-sent prediction counts, so the fan-out is part of
the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions import JOIN_KEYS, from_epoch, has_keys, time_slot
from tramline.operators import skew
from tramline.operators.resent import join_stretches, stretches
from tramline.schemas import FACT
from tramline.session import raise_partitions

BOUND_SECONDS = 600
# Join slots are this many bounds wide: an update is copied to 1 + 2 / 6 slots on average, and a
# position is compared with at most 8 bounds' worth of updates instead of a key's whole history.
SLOT_BOUNDS = 6
# Positions without a time are spread over this many slots from this number on.
TIMELESS_SLOT, TIMELESS_SLOTS = -(1 << 62), 1 << 20

UPDATE_COLUMNS = ["arrival_time", "departure_time", "arrival_uncertainty", "ingested_at"]
POSITION_COLUMNS = [name for name in FACT if name not in UPDATE_COLUMNS]


def clean_positions(positions: DataFrame) -> DataFrame:
    """Usable positions with an event timestamp, without the attributes of the vehicle dimension."""
    return (
        positions.filter(has_keys())
        .drop("vehicle_label", "license_plate")
        .withColumn("vehicle_timestamp", from_epoch(F.col("vehicle_timestamp")))
    )


def clean_updates(updates: DataFrame) -> DataFrame:
    return updates.filter(has_keys())


def _interval(seconds: int) -> Column:
    return F.expr(f"INTERVAL {seconds} SECONDS")


def within(bound: int) -> Column:
    at = F.col("vehicle_timestamp")
    return F.col("ingested_at").between(at - _interval(bound), at + _interval(bound))


def slot_of(at: Column, bound: int) -> Column:
    """Number of the time slot an instant (epoch microseconds) falls into in a stream's join.

    Slots begin half a slot off the round hours, around which timetables and so updates crowd.
    """
    width = bound * SLOT_BOUNDS
    return time_slot(at + F.lit(width * 500_000), width)


def slotted(rows: DataFrame, time: str, bound: int) -> DataFrame:
    """Positions with the slot of their time, so that a key's history is not one group."""
    return rows.withColumn("slot", slot_of(F.unix_micros(time), bound))


def in_reach(rows: DataFrame, bound: int, first: str = "ingested_at", last: str = "ingested_at") -> DataFrame:
    """Updates, or stretches of them, once in every slot that holds positions within the bound of them."""
    since, until = F.unix_micros(first) - bound * 1_000_000, F.unix_micros(last) + bound * 1_000_000
    return rows.withColumn("slot", F.explode(F.sequence(slot_of(since, bound), slot_of(until, bound))))


def join_updates(
    left: DataFrame, right: DataFrame, bound: int | None, keys: Sequence[str] = JOIN_KEYS
) -> DataFrame:
    """Left outer join in one plan, the same for batch tables and for watermarked streams."""
    positions, updates = left.alias("positions"), right.alias("updates")
    on = [F.col(f"positions.{key}") == F.col(f"updates.{key}") for key in keys]
    if bound is not None:
        on.append(within(bound))
    return positions.join(updates, reduce(and_, on), "left_outer").select(
        *(f"positions.{name}" for name in POSITION_COLUMNS), *(f"updates.{name}" for name in UPDATE_COLUMNS)
    ).select(*FACT)


def build_fact(
    positions: DataFrame,
    updates: DataFrame,
    bound: int | None = BOUND_SECONDS,
    rows_per_task: int = skew.ROWS_PER_TASK,
    resent: bool = False,
) -> DataFrame:
    """Fact table of two bronze batch tables; without a bound, every update of the key matches.

    ``resent`` joins the polls of equal updates as one row, for feeds that repeat them; the result is the
    same. Keys that are hot even so are split as ever, poll by poll.

    Trips run again every day under the same id, so the time slot is part of the hash key: without
    it one key would collect its whole history. Keys that stay hot within a slot are measured
    first and split; usually there are none and the plan is the single join.
    """
    if bound is not None and bound < 1:
        raise ValueError("the bound must be at least one second")
    if bound is None and resent:
        raise ValueError("only a join with a bound takes updates together")
    right = clean_updates(updates).select(*JOIN_KEYS, *UPDATE_COLUMNS)
    if bound is None:
        left = clean_positions(positions).select(*POSITION_COLUMNS)
        return _join_measured(left, right, list(JOIN_KEYS), None, rows_per_task)

    left = clean_positions(positions).select(*POSITION_COLUMNS)
    right = right.filter(F.col("ingested_at").isNotNull())
    width = bound * SLOT_BOUNDS
    at = F.unix_micros("ingested_at")
    reach = bound * 1_000_000
    # A position without a time matches nothing; as a null key all would meet in one task. They get
    # slots of their own, before any that an update can have, so one scan serves both kinds.
    nowhere = F.lit(TIMELESS_SLOT) + F.pmod(F.xxhash64(*POSITION_COLUMNS), F.lit(TIMELESS_SLOTS))
    left = left.withColumn("slot", F.coalesce(time_slot(F.unix_micros("vehicle_timestamp"), width), nowhere))
    right = right.withColumn("slot", F.explode(F.sequence(time_slot(at - reach, width), time_slot(at + reach, width))))
    return _join_measured(left, right, [*JOIN_KEYS, "slot"], bound, rows_per_task, resent)


def _join_cold(left: DataFrame, right: DataFrame, keys: list[str], bound: int | None, resent: bool) -> DataFrame:
    if resent:
        return join_stretches(left, stretches(right, keys, bound), bound, keys)
    return join_updates(left, right, bound, keys)


def _join_measured(
    left: DataFrame, right: DataFrame, keys: list[str], bound: int | None, rows_per_task: int, resent: bool = False
) -> DataFrame:
    split = skew.plan_split(skew.stored(skew.cell_counts(left, right, keys)), rows_per_task)
    raise_partitions(left.sparkSession, split.rows)
    if split.hot is None:
        return _join_cold(left, right, keys, bound, resent)
    cold = _join_cold(skew.outside(left, keys, split.hot), skew.outside(right, keys, split.hot), keys, bound, resent)
    return cold.unionByName(_join_hot(left, right, keys, bound, split.hot))


def _join_hot(left: DataFrame, right: DataFrame, keys: list[str], bound: int | None, hot: DataFrame) -> DataFrame:
    """The same left outer join with both sides of every cell split into parts.

    Each position part meets each update part in its own task, so a pair is found exactly once.
    No single task can tell that a position has no partner at all; that comes from one summary row
    per key and time step, joined separately.
    """
    split_left = skew.collapse_copies(skew.inside(left, keys, hot), "left_parts", "left_part", "left_weight")
    split_right = skew.collapse_copies(skew.inside(right, keys, hot), "right_parts", "right_part", "right_weight")
    # A given number of partitions, because adaptive execution would merge parts that look small
    # until their weights are spread out again.
    partitions = skew.split_partitions(hot)

    on = [*keys, "left_part", "right_part"]
    every_left = split_left.withColumn("right_part", skew.every_part("right_parts"))
    every_right = split_right.withColumn("left_part", skew.every_part("left_parts")).drop("left_parts", "right_parts")
    pairs = every_left.repartition(partitions, *on).join(every_right.repartition(partitions, *on), on)
    if bound is not None:
        pairs = pairs.filter(within(bound))
    pairs = skew.spread_weight(skew.spread_weight(pairs, "left_weight"), "right_weight")

    if bound is None:
        partnered = _any_update(right, keys, hot)
        on = [*keys, "left_part"]
        lonely = split_left.repartition(partitions, *on).join(partnered.repartition(partitions, *on), on, "left_anti")
    else:
        step = time_slot(F.unix_micros("vehicle_timestamp"), bound)
        near = _nearest_updates(right, keys, bound, hot)
        has_partner = (
            F.col("here")
            | (F.col("before") >= F.col("vehicle_timestamp") - _interval(bound))
            | (F.col("after") <= F.col("vehicle_timestamp") + _interval(bound))
        )
        on = [*keys, "step", "left_part"]
        lonely = (
            split_left.withColumn("step", step)
            .repartition(partitions, *on)
            .join(near.repartition(partitions, *on), on, "left_outer")
            .filter(~F.coalesce(has_partner, F.lit(False)))
        )
    lonely = skew.spread_weight(lonely.select(*left.columns, "left_weight"), "left_weight")
    return pairs.select(*FACT).unionByName(lonely.select(*POSITION_COLUMNS), allowMissingColumns=True)


def _any_update(right: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """One row per hot key with updates, for every position part."""
    known = skew.inside(right.select(*keys), keys, hot).select(*keys, "left_parts").distinct()
    return known.select(*keys, skew.every_part("left_parts").alias("left_part"))


def _nearest_updates(right: DataFrame, keys: list[str], bound: int, hot: DataFrame) -> DataFrame:
    """Per key and step of one bound: is there an update in it, the last before, the first after.

    A step lies wholly within the bound of any position in it, so these three settle whether such
    a position has a partner. Updates are already copied to every slot they can reach, which keeps
    the neighbours of a slot's first and last step inside the slot.
    """
    step = time_slot(F.unix_micros("ingested_at"), bound)
    group = [*keys, "left_parts", "step"]
    steps = (
        skew.inside(right, keys, hot)
        .withColumn("step", step)
        .groupBy(*group)
        .agg(F.min("ingested_at").alias("first"), F.max("ingested_at").alias("last"))
    )
    neighbours = F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("shift")
    near = (
        steps.select("*", neighbours)
        .withColumn("step", F.col("step") + F.col("shift"))
        .groupBy(*group)
        .agg(
            F.max(F.col("shift") == 0).alias("here"),
            F.max(F.when(F.col("shift") == 1, F.col("last"))).alias("before"),
            F.min(F.when(F.col("shift") == -1, F.col("first"))).alias("after"),
        )
    )
    return near.withColumn("left_part", skew.every_part("left_parts")).drop("left_parts")
