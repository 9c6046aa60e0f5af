"""Nested feed snapshots to flat topic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions import STOP_STATUS, TRIP_RELATIONSHIP, enum_name
from tramline.schemas import TRIP_UPDATE, VEHICLE_POSITION


def _under(parent: str, child: str, unset: object, kind: str) -> Column:
    """A leaf whose presence is that of its parent message.

    Parent absent: null. Parent present but the leaf unset: the message format's default.
    """
    leaf = F.coalesce(F.col(f"{parent}.{child}"), F.lit(unset))
    return F.when(F.col(parent).isNotNull(), leaf.cast(kind)).alias(child)


def _trip_fields(trip: str) -> list[Column]:
    relationship = enum_name(F.coalesce(F.col(f"{trip}.schedule_relationship"), F.lit(0)), TRIP_RELATIONSHIP)
    return [
        *(_under(trip, name, "", "string") for name in ("trip_id", "route_id", "start_date")),
        F.when(F.col(trip).isNotNull(), relationship).alias("schedule_relationship"),
    ]


def _entities(snapshots: DataFrame, part: str) -> DataFrame:
    """One row per entity that carries the given part."""
    return snapshots.select(
        F.coalesce("header.timestamp", F.lit(0)).alias("feed_timestamp"),
        F.explode("entity").alias("entity"),
    ).select("feed_timestamp", F.col("entity.id").alias("entity_id"), F.col(f"entity.{part}").alias(part)).filter(
        F.col(part).isNotNull()
    )


def vehicle_positions(snapshots: DataFrame) -> DataFrame:
    """One 17-column record per entity with a vehicle."""
    plate = [
        _under("vehicle.vehicle", child, "", "string").alias(name)
        for child, name in (("id", "vehicle_id"), ("label", "vehicle_label"), ("license_plate", "license_plate"))
    ]
    return (
        _entities(snapshots, "vehicle")
        .select(
            "entity_id",
            "feed_timestamp",
            *_trip_fields("vehicle.trip"),
            *(_under("vehicle.position", name, 0.0, "double") for name in ("latitude", "longitude")),
            *(_under("vehicle.position", name, 0.0, "float") for name in ("bearing", "speed")),
            "vehicle.current_stop_sequence",
            enum_name(F.col("vehicle.current_status"), STOP_STATUS).alias("current_status"),
            "vehicle.stop_id",
            F.col("vehicle.timestamp").alias("vehicle_timestamp"),
            *plate,
        )
        .select(*VEHICLE_POSITION)
    )


def trip_updates(snapshots: DataFrame) -> DataFrame:
    """One 11-column record per stop time update; an update without stops gives no record."""
    stops = _entities(snapshots, "trip_update").select(
        "entity_id",
        "feed_timestamp",
        F.col("trip_update.trip").alias("trip"),
        F.explode("trip_update.stop_time_update").alias("stop"),
    )
    return stops.select(
        "entity_id",
        "feed_timestamp",
        *_trip_fields("trip"),
        "stop.stop_sequence",
        "stop.stop_id",
        _under("stop.arrival", "time", 0, "bigint").alias("arrival_time"),
        _under("stop.arrival", "uncertainty", 0, "int").alias("arrival_uncertainty"),
        _under("stop.departure", "time", 0, "bigint").alias("departure_time"),
    ).select(*TRIP_UPDATE)


def poll_counts(records: DataFrame) -> DataFrame:
    """Records sent per poll of a feed."""
    return records.groupBy("feed_timestamp").agg(F.count(F.lit(1)).alias("record_count"))
