"""Epochs, service-day clock times, load numbers and time slots."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


# Epoch seconds of the years 1 to 9999; a feed that sends milliseconds or nonsense lies outside.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799
# Hours that a clock text may have.
MAX_HOURS = 1_000


def in_range(seconds: Column) -> Column:
    """The seconds, or null where they are no instant of a four-digit year."""
    return F.when(seconds.between(FIRST_SECOND, LAST_SECOND), seconds)


def from_epoch(seconds: Column) -> Column:
    """Epoch seconds as an instant; a number that is no instant of the years 1 to 9999 gives null.

    One bad number must not stop a stream that would read it again at each restart. It never passes through local text, so the two passes of a repeated autumn hour stay apart
    whatever the session zone is.
    """
    return F.timestamp_seconds(in_range(seconds))


def known_epoch(seconds: Column) -> Column:
    """Epoch seconds with the feed's 0, and what is no instant, read as "unknown"."""
    return F.nullif(in_range(seconds), F.lit(0).cast("bigint"))


def new_load_number(now: datetime | None = None) -> str:
    """One number per run, shared by all tables the run loads."""
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")


def clock_seconds(clock: Column) -> Column:
    """``HH:MM:SS`` as seconds; hours run past 24 for trips that cross midnight.

    Bad text is null, and so are more than ``MAX_HOURS`` hours either way.
    """
    parts = F.split(F.trim(clock), ":")
    hours, minutes, seconds = (F.try_element_at(parts, F.lit(i)).try_cast("int") for i in (1, 2, 3))
    total = hours.cast("bigint") * 3600 + minutes.cast("bigint") * 60 + seconds
    limit = MAX_HOURS * 3600
    return F.when(total.between(-limit, limit), total.cast("int"))


def service_time(service_date: Column, seconds: Column, zone: str) -> Column:
    """Instant of a schedule time, which the public GTFS text counts from noon minus 12 hours.

    On days when the clocks change that differs from counting from midnight.
    """
    noon = F.make_timestamp(
        F.year(service_date),
        F.month(service_date),
        F.dayofmonth(service_date),
        F.lit(12),
        F.lit(0),
        F.lit(0),
        F.lit(zone),
    )
    return F.timestamp_seconds(F.unix_seconds(noon) - 12 * 3600 + seconds)


def time_slot(micros: Column, width_seconds: int) -> Column:
    """Number of the fixed-width time slot an instant (epoch microseconds) falls into."""
    width = F.lit(width_seconds * 1_000_000)
    return ((micros - F.pmod(micros, width)) / width).cast("bigint")
