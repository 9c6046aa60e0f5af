"""Updates that a feed sends again unchanged at each poll, as one row per stretch of time.

A feed repeats every prediction about every 15 seconds until it changes, so a position meets some 80 equal
updates. Here the polls of equal updates of one stretch are one row with its first, last and list of
polls. The join meets those few rows, on the condition that any of their polls is near enough, and only
then are the polls that are near listed: the result is that of joining them one by one.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions import time_slot
from tramline.schemas import FACT

# What makes two updates of a key equal.
VALUES = ["arrival_time", "departure_time", "arrival_uncertainty"]


def stretches(updates: DataFrame, keys: Sequence[str], seconds: int) -> DataFrame:
    """keys, values, first, last and polls of each stretch of ``seconds``; repeated polls stay repeated.

    Polls are gathered map-side, and a row holds no more than one key's equal updates of one stretch.
    """
    stretch = time_slot(F.unix_micros("ingested_at"), seconds).alias("stretch")
    return updates.groupBy(*keys, *VALUES, stretch).agg(
        F.min("ingested_at").alias("first"), F.max("ingested_at").alias("last"), F.collect_list("ingested_at").alias("polls")
    )


def streamed_stretches(updates: DataFrame, keys: Sequence[str], seconds: int) -> DataFrame:
    """The same of a stream with a watermark on ``ingested_at``; a stretch is given once it is over.

    ``held_at`` is the end of its window, with the watermark, for the join to tell when it can forget.
    """
    held = F.window("ingested_at", f"{seconds} seconds").alias("held")
    rows = updates.groupBy(*keys, *VALUES, held).agg(
        F.min("ingested_at").alias("first"), F.max("ingested_at").alias("last"), F.collect_list("ingested_at").alias("polls")
    )
    return rows.withColumn("held_at", F.window_time("held")).drop("held")


def near_polls(bound: int) -> Column:
    """The polls within the bound of the position, both ends included."""
    at, reach = F.col("vehicle_timestamp"), F.expr(f"INTERVAL {bound} SECONDS")
    return F.filter("polls", lambda poll: poll.between(at - reach, at + reach))


def join_stretches(left: DataFrame, right: DataFrame, bound: int, keys: Sequence[str], reached: Column | None = None) -> DataFrame:
    """Positions with every poll near them, or once with nulls; one plan for batch and stream.

    ``reached`` is what a stream needs to know besides, to forget rows.
    """
    positions, updates = left.alias("positions"), right.alias("updates")
    at, reach = F.col("vehicle_timestamp"), F.expr(f"INTERVAL {bound} SECONDS")
    on = [F.col(f"positions.{key}") == F.col(f"updates.{key}") for key in keys]
    on += [at >= F.col("first") - reach, at <= F.col("last") + reach, F.size(near_polls(bound)) > 0]
    on += [] if reached is None else [reached]
    own = [name for name in FACT if name not in VALUES and name != "ingested_at"]
    met = positions.join(updates, reduce(and_, on), "left_outer").select(
        *(f"positions.{name}" for name in own), *(f"updates.{name}" for name in VALUES), "updates.polls"
    )
    return met.withColumn("ingested_at", F.explode_outer(near_polls(bound))).select(*FACT)
