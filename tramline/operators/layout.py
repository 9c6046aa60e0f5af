"""A space-filling order over several columns, so that a filter on any of them skips most of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ranges per column (a power of two), and values of each column that the ranges are drawn from.
BITS = 6
SAMPLED = 20_000
# Rows that agree in all ordered columns are still cut into this many ranges.
SALTS = 1024


def cut_points(rows: DataFrame, columns: Sequence[str], bits: int = BITS, sampled: int = SAMPLED) -> list[list]:
    """For each column the values that cut it into up to 2 ** bits ranges of about as many rows each.

    They come from a random sample of bounded size, the only rows that reach the driver, and decide the
    order alone: another sample gives another layout of the same rows.
    """
    few = rows.select(*columns).orderBy(F.rand(7)).limit(sampled).collect()
    points = []
    for i in range(len(columns)):
        known = sorted(row[i] for row in few if row[i] is not None)
        ranges = 1 << bits
        points.append(sorted({known[len(known) * k // ranges] for k in range(1, ranges)}) if known else [])
    return points


def _number(column: str, points: list) -> Column:
    """In which range a value lies; null lies in the first."""
    tests = (F.coalesce((F.col(column) >= F.lit(point)).cast("int"), F.lit(0)) for point in points)
    return reduce(add, tests, F.lit(0)).cast("long")


def curve_place(columns: Sequence[str], points: list[list], bits: int = BITS) -> Column:
    """Place on the curve: the bits of all columns' range numbers in turn, highest first."""
    width, place = len(columns), F.lit(0).cast("long")
    if width * bits > 62:
        raise ValueError("too many columns or bits for one number")
    for i, (column, own) in enumerate(zip(columns, points, strict=True)):
        number = _number(column, own)
        for bit in range(bits):
            taken = F.shiftright(number, bit).bitwiseAND(F.lit(1).cast("long"))
            place = place.bitwiseOR(F.shiftleft(taken, bit * width + width - 1 - i))
    return place


def laid_out(rows: DataFrame, columns: Sequence[str], partitions: int, bits: int = BITS) -> DataFrame:
    """``rows`` in ``partitions`` ranges of the curve, each sorted along it.

    Range partitioning samples the rows, so ranges hold about as many each; a combination that holds
    very many rows is spread by a hash of the whole row. ``rows`` should be stored: they are read once for
    the cut points, once for the ranges and once for the shuffle.
    """
    place = curve_place(columns, cut_points(rows, columns, bits), bits)
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS))
    keyed = rows.select(F.struct(*rows.columns).alias("row"), place.alias("place"), salt.alias("salt"))
    order = ["place", *(F.col(f"row.{c}") for c in columns), "salt"]
    return keyed.repartitionByRange(partitions, *order).sortWithinPartitions(*order).select("row.*")
