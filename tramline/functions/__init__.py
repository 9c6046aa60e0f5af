"""Column expressions shared by the operators."""

from tramline.functions.enums import STOP_STATUS, TRIP_RELATIONSHIP, enum_name
from tramline.functions.keys import JOIN_KEYS, has_keys, has_value
from tramline.functions.times import (
    clock_seconds,
    from_epoch,
    known_epoch,
    new_load_number,
    service_time,
    time_slot,
)

__all__ = [
    "JOIN_KEYS",
    "STOP_STATUS",
    "TRIP_RELATIONSHIP",
    "clock_seconds",
    "enum_name",
    "from_epoch",
    "has_keys",
    "has_value",
    "known_epoch",
    "new_load_number",
    "service_time",
    "time_slot",
]
