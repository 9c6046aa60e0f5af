"""Dimension lookups: left joins of a large table with a table unique on the key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.operators.skew import ROWS_PER_TASK, hot_keys

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(table: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the table was measured, in one pass, to be small enough to copy to every executor."""
    size = F.octet_length(F.to_json(F.struct(*table.columns)))
    rows, total = table.agg(F.count(F.lit(1)), F.sum(size)).first()
    return rows <= max_rows and (total or 0) <= max_bytes


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(and_, (F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}")) for key in keys))


def lookup(
    rows: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    broadcast_rows: int = BROADCAST_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
    measured: DataFrame | None = None,
) -> DataFrame:
    """Add the dimension's columns, null where the key is unknown.

    ``measured`` has the same keys as ``rows`` and is cheaper to read, for the search for hot keys.

    A dimension measured to be small is broadcast. Otherwise both sides shuffle, except the rows
    of hot keys: these stay where they are and get the few dimension rows they need broadcast.
    """
    if fits_broadcast(dim, broadcast_rows):
        return rows.join(F.broadcast(dim), list(keys), "left")
    return shuffled_lookup(rows, dim, keys, rows_per_task, measured)


def shuffled_lookup(
    rows: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
    measured: DataFrame | None = None,
) -> DataFrame:
    """Lookup in a dimension too large to broadcast, or not worth measuring."""
    keys = list(keys)
    hot = hot_keys(rows if measured is None else measured, keys, rows_per_task)
    if hot is None or not fits_broadcast(hot):
        return rows.join(dim, keys, "left")
    # Null keys match nothing but would all shuffle to one task, so null counts as a key here.
    in_hot = _same("rows", "hot", keys)
    few = F.broadcast(hot.alias("hot"))
    cold_rows = rows.alias("rows").join(few, in_hot, "left_anti")
    hot_rows = rows.alias("rows").join(few, in_hot, "left_semi")
    hot_dim = dim.join(F.broadcast(hot), keys, "left_semi")
    if not fits_broadcast(hot_dim):
        # The dimension repeats its key or has huge rows; adaptive execution splits what it can.
        return rows.join(dim, keys, "left")
    return cold_rows.join(dim, keys, "left").unionByName(hot_rows.join(F.broadcast(hot_dim), keys, "left"))
