"""Dimensions with history: every state of a key is a row, valid from one load to the next that differs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAMPS = {
    "created_at": "timestamp",
    "updated_at": "timestamp",
    "valid_from": "timestamp",
    "valid_to": "timestamp",
    "load_number": "string",
    "row_hash": "string",
}


def row_hash(columns: Sequence[str]) -> Column:
    """Digest of some columns' values; a null differs from an empty text and from a missing neighbour."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).cast("binary"))


def _known(keys: Sequence[str]) -> Column:
    return reduce(and_, (F.col(key).isNotNull() for key in keys))


def unique_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the greatest by its other columns; rows with a null in the key have no identity and go."""
    others = [name for name in rows.columns if name not in keys]
    if not others:
        return rows.filter(_known(keys)).distinct()
    return rows.filter(_known(keys)).groupBy(*keys).agg(F.max(F.struct(*others)).alias("row")).select(*keys, "row.*")


def merge_history(
    history: DataFrame, incoming: DataFrame, keys: Sequence[str], now: Column, load_number: str, complete: bool = True
) -> DataFrame:
    """``history`` (``incoming``'s columns and the stamps) after a load of ``incoming``.

    A key whose other columns changed gets a new row; the old one ends where it begins. ``created_at``
    stays that of the key's first row, also when it comes back after it was gone, and ``updated_at`` is
    when the row began. A key that is gone is closed, unless the load is not ``complete``. Equal rows
    stay as they are, so the same load again changes nothing.

    One full outer join of the open rows with the load, both unique by key, so no key is hot.
    """
    keys = list(keys)
    others = [name for name in incoming.columns if name not in keys]
    columns = [*keys, *others, *STAMPS]
    closed = history.filter("valid_to IS NOT NULL").select(*columns)
    open_ = history.filter("valid_to IS NULL").select(*keys, F.struct(*[c for c in columns if c not in keys]).alias("old"))
    fresh = unique_rows(incoming, keys).withColumn("row_hash", row_hash(others))
    fresh = fresh.select(*keys, F.struct(*others, "row_hash").alias("new"))
    first = closed.groupBy(*keys).agg(F.min("created_at").alias("first"))
    met = open_.join(fresh, keys, "full_outer").join(first, keys, "left")

    is_old, is_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    changed = is_old & is_new & (F.col("old.row_hash") != F.col("new.row_hash"))
    ends = changed | (is_old & ~is_new) if complete else changed
    end = F.when(ends, now).cast("timestamp")
    kept = {c: F.col(f"old.{c}") for c in [*others, *STAMPS]} | {"valid_to": end}
    begun = {c: F.col(f"new.{c}") for c in others} | {
        "created_at": F.coalesce("old.created_at", "first", now),
        "updated_at": now,
        "valid_from": now,
        "valid_to": F.lit(None).cast("timestamp"),
        "load_number": F.lit(load_number),
        "row_hash": F.col("new.row_hash"),
    }

    def row(values: dict[str, Column]) -> Column:
        return F.struct(*(values[c].alias(c) for c in [*others, *STAMPS]))

    rows = F.array_compact(F.array(F.when(is_old, row(kept)), F.when(is_new & (~is_old | changed), row(begun))))
    merged = met.select(*keys, F.explode(rows).alias("row")).select(*keys, "row.*")
    return merged.select(*columns).unionByName(closed)


def as_of(history: DataFrame, at: Column) -> DataFrame:
    """The rows that were valid at an instant."""
    return history.filter((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))
