"""Required-key predicate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

JOIN_KEYS = ("trip_id", "route_id", "stop_id")


def has_value(name: str) -> Column:
    """Not null and not made of spaces only.

    The null test is implied by the second, but on its own it is a predicate that reaches the scan.
    """
    return F.col(name).isNotNull() & (F.trim(name) != "")


def has_keys(names: Sequence[str] = JOIN_KEYS) -> Column:
    return reduce(and_, map(has_value, names))
