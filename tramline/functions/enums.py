"""Enum numbers of the public GTFS-realtime specification and their names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
TRIP_RELATIONSHIP = {
    0: "SCHEDULED",
    1: "ADDED",
    2: "UNSCHEDULED",
    3: "CANCELED",
    5: "REPLACEMENT",
    6: "DUPLICATED",
    7: "DELETED",
    8: "NEW",
}
STOP_STATUS = {0: "INCOMING_AT", 1: "STOPPED_AT", 2: "IN_TRANSIT_TO"}


def enum_name(number: Column, names: dict[int, str]) -> Column:
    """Name of an enum number; null for null and for numbers outside the specification."""
    pairs = [F.lit(part) for item in names.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), number)
