"""Accounts of fact rows: how many there are per key cell and time window, and a digest of them.

Counts and digests are sums, so accounts of parts merge into that of the whole, in any order, and two
tables hold the same rows in a window if its counts and digests agree. The digest is a sum of 64-bit row
hashes: rows that differ leave equal sums with a chance of about one in 2^64 per window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions import JOIN_KEYS, time_slot
from tramline.schemas import FACT

CELLS = 4096
WINDOW_SECONDS = 3600
# The window of positions without a time.
NO_TIME = -(1 << 62)

PLACE = ["cell", "window"]


def cell() -> Column:
    return F.pmod(F.xxhash64(*JOIN_KEYS), F.lit(CELLS)).cast("int")


def window(at: Column) -> Column:
    """Number of the window an instant lies in."""
    return F.coalesce(time_slot(F.unix_micros(at), WINDOW_SECONDS), F.lit(NO_TIME))


def placed(rows: DataFrame) -> DataFrame:
    """Positions or fact rows with their cell and the window of their vehicle time."""
    return rows.withColumns({"cell": cell(), "window": window(F.col("vehicle_timestamp"))})


def account(rows: DataFrame) -> DataFrame:
    """cell, window, row_count, digest of fact rows; combines map-side to a row per cell and window."""
    # A hash passes over nulls, so which columns are null is hashed as well.
    digest = F.xxhash64(*FACT, *(F.col(name).isNull() for name in FACT)).cast("decimal(38,0)")
    return placed(rows).groupBy(*PLACE).agg(F.count(F.lit(1)).alias("row_count"), F.sum(digest).alias("digest"))


def merged(accounts: DataFrame) -> DataFrame:
    """The account of all parts together."""
    return accounts.groupBy(*PLACE).agg(F.sum("row_count").alias("row_count"), F.sum("digest").alias("digest"))


def differing(expected: DataFrame, given: DataFrame) -> DataFrame:
    """cell, window, expected_rows, given_rows where two accounts disagree; no rows count as zero."""
    one = expected.select(*PLACE, F.col("row_count").alias("expected_rows"), F.col("digest").alias("d1"))
    two = given.select(*PLACE, F.col("row_count").alias("given_rows"), F.col("digest").alias("d2"))
    both = one.join(two, PLACE, "full_outer").na.fill(0, ["expected_rows", "given_rows"])
    return both.filter(~F.col("d1").eqNullSafe(F.col("d2")) | (F.col("expected_rows") != F.col("given_rows"))).drop("d1", "d2")
