"""Static and derived dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions import has_keys
from tramline.schemas import VEHICLE_DIM, Columns


def static_dim(rows: DataFrame, columns: Columns, load_number: str) -> DataFrame:
    """The wanted columns by name, in their declared types, stamped with the load number.

    The input holds text only, so ids keep leading zeros; text that is no number becomes null.
    Other input columns are ignored and a missing one is an error.
    """
    typed = [
        F.col(name) if kind == "string" else F.col(name).try_cast(kind).alias(name) for name, kind in columns.items()
    ]
    return rows.select(*typed, F.lit(load_number).alias("load_number"))


def vehicle_dim(positions: DataFrame) -> DataFrame:
    """Distinct vehicle attributes of usable positions; null equals null, an id may repeat.

    Duplicates collapse map-side, so a vehicle seen a billion times shuffles one row per task.
    """
    return positions.filter(has_keys()).select(*VEHICLE_DIM).dropDuplicates()


def seen_vehicles(positions: DataFrame) -> DataFrame:
    """Distinct attributes of known vehicles and when each was last reported; such tables merge."""
    return (
        positions.filter(has_keys() & F.col("vehicle_id").isNotNull())
        .groupBy(*VEHICLE_DIM)
        .agg(F.max("vehicle_timestamp").alias("seen_at"))
    )


def newest_vehicles(seen: DataFrame) -> DataFrame:
    """One row per vehicle id: its most recently reported attributes."""
    newest = F.max(F.struct("seen_at", "vehicle_label", "license_plate"))
    return (
        seen.groupBy("vehicle_id")
        .agg(newest.alias("newest"))
        .select("vehicle_id", "newest.vehicle_label", "newest.license_plate")
    )


def latest_vehicles(positions: DataFrame) -> DataFrame:
    """One row per known vehicle id: its most recently reported attributes.

    The first aggregation hashes and combines map-side down to distinct attributes; only those
    reach the ordered one.
    """
    return newest_vehicles(seen_vehicles(positions))
