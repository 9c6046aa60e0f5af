"""Finding and splitting hot groups of a join.

Join keys are hashed into a fixed number of cells. Counting rows per cell combines map-side to at
most ``CELLS`` rows per task and in total, whatever the data size, so the table of hot cells is
safe to broadcast. Splitting a cell only changes which task sees a row, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.session import PARTITIONS_PER_SLOT, task_slots, work_root

CELLS = 65_536
ROWS_PER_TASK = 2_000_000
# A cell is split only if it is also this many times larger than the average cell.
OVER_MEAN = 2
# Comparisons a single pair of parts may make. Cells are also judged by left rows times right rows, since
# two sides of moderate size can still make more pairs than a task gets through.
PAIRS_PER_TASK = 2_000_000_000
# A stream's hot cell is cut into two parts, and further only while a part is more than one of this many shares
# of a state partition: smaller parts even nothing out, but every row is copied to all parts of the other side.
SHARES_PER_TASK = 8
# Exact copies of a row travel as one row with a weight, cut into chunks of at least this weight.
COPIES_PER_CHUNK = 1_000
MAX_CHUNKS = 100_000


def cell(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(CELLS)).cast("int")


def cell_counts(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(cell, left_rows, right_rows), in one pass over the key columns of both sides."""
    number = cell(keys).alias("cell")
    return (
        left.select(number, F.lit(1).alias("left"), F.lit(0).alias("right"))
        .unionAll(right.select(number, F.lit(0), F.lit(1)))
        .groupBy("cell")
        .agg(F.sum("left").alias("left_rows"), F.sum("right").alias("right_rows"))
    )


def window_counts(left: DataFrame, right: DataFrame, keys: Sequence[str], window: str) -> DataFrame:
    """(cell, left_rows, right_rows) of each cell's fullest window, for each side."""
    columns = [cell(keys).alias("cell"), F.col(window)]
    per_window = (
        left.select(*columns, F.lit(1).alias("left"), F.lit(0).alias("right"))
        .unionAll(right.select(*columns, F.lit(0), F.lit(1)))
        .groupBy("cell", window)
        .agg(F.sum("left").alias("left"), F.sum("right").alias("right"))
    )
    return per_window.groupBy("cell").agg(F.max("left").alias("left_rows"), F.max("right").alias("right_rows"))


def _limit(rows: int, rows_per_task: int) -> int:
    """Rows a single cell or key may have before it counts as hot."""
    return max(1, rows_per_task, rows * OVER_MEAN // CELLS)


@dataclass(frozen=True)
class Split:
    """What measuring two join sides found: their size, and the cells to cut up, if any."""

    rows: int
    hot: DataFrame | None


def plan_split(
    counts: DataFrame,
    rows_per_task: int = ROWS_PER_TASK,
    pairs_per_task: int = PAIRS_PER_TASK,
    tasks: int | None = None,
) -> Split:
    """Hot cells, as (cell, left_parts, right_parts), from a table of cell counts.

    A side is cut so that no part has more rows than a task should; then both sides are cut further, by
    the same factor, until no two parts make more pairs than a task should. Given the number of ``tasks`` the
    rows are dealt to, parts need be no smaller than is of use to them.
    """
    sides = ("left_rows", "right_rows")
    product = F.col("left_rows").cast("double") * F.col("right_rows")
    totals = counts.agg(*(F.sum(side) for side in sides), *(F.max(side) for side in sides), F.max(product)).first()
    rows, largest = [n or 0 for n in totals[:2]], [n or 0 for n in totals[2:4]]
    limits = [_limit(n, rows_per_task) for n in rows]
    # A cell of average size holds many small keys, whose rows never meet each other's.
    pairs = max(1.0, float(pairs_per_task), rows[0] * OVER_MEAN / CELLS * (rows[1] * OVER_MEAN / CELLS))
    if all(n <= limit for n, limit in zip(largest, limits)) and (totals[4] or 0) <= pairs:
        return Split(sum(rows), None)
    by_rows = [F.greatest(F.lit(1), F.ceil(F.col(side) / limit)) for side, limit in zip(sides, limits)]
    if tasks is not None:
        shares = [-(-n // (tasks * SHARES_PER_TASK)) for n in rows]
        enough = [F.greatest(F.lit(2), F.ceil(F.col(side) / max(1, n))) for side, n in zip(sides, shares)]
        by_rows = [F.least(parts, most) for parts, most in zip(by_rows, enough)]
    further = F.sqrt(F.greatest(F.lit(1.0), product / by_rows[0] / by_rows[1] / F.lit(pairs)))
    left_parts, right_parts = (
        F.least(F.ceil(parts * further), F.greatest(F.col(side), F.lit(1))).cast("int")
        for parts, side in zip(by_rows, sides)
    )
    hot = counts.select("cell", left_parts.alias("left_parts"), right_parts.alias("right_parts"))
    return Split(sum(rows), hot.filter("left_parts > 1 or right_parts > 1"))


def split_partitions(hot: DataFrame) -> int:
    """One partition per pair of parts, as far as the cluster has use for them."""
    spark = hot.sparkSession
    pairs = hot.agg(F.sum(F.col("left_parts").cast("bigint") * F.col("right_parts"))).first()[0]
    return min(pairs, task_slots(spark) * PARTITIONS_PER_SLOT)


def stored(stats: DataFrame) -> DataFrame:
    """Statistics computed once and cut off from their inputs."""
    work_root(stats.sparkSession)
    return stats.checkpoint()


def hot_keys(rows: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame | None:
    """The keys, null among them, that alone hold too many rows; at most ``CELLS / OVER_MEAN``.

    Keys are only counted one by one inside cells that are themselves above the limit.
    """
    numbered = rows.select(*keys, cell(keys).alias("cell"))
    counts = stored(numbered.groupBy("cell").agg(F.count(F.lit(1)).alias("cell_rows")))
    total, largest = (n or 0 for n in counts.agg(F.sum("cell_rows"), F.max("cell_rows")).first())
    limit = _limit(total, rows_per_task)
    if largest <= limit:
        return None
    full = counts.filter(F.col("cell_rows") > limit).select("cell")
    suspects = numbered.join(F.broadcast(full), "cell", "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows"))
    hot = stored(suspects.filter(F.col("key_rows") > limit).select(*keys))
    return None if hot.isEmpty() else hot


def outside(rows: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """Rows of cells that need no splitting."""
    return rows.withColumn("cell", cell(keys)).join(F.broadcast(hot), "cell", "left_anti").drop("cell")


def inside(rows: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    """Rows of hot cells, with the cell's part numbers."""
    return rows.withColumn("cell", cell(keys)).join(F.broadcast(hot), "cell").drop("cell")


def collapse_copies(rows: DataFrame, parts: str, part: str, weight: str) -> DataFrame:
    """Exact copies as weighted rows, each given a part by value.

    Floating-point columns are told apart by their text, since grouping by the numbers would make one
    row of 0.0 and -0.0. A part drawn from the row's own values is the same when a lost task is run again, which a
    random one would not be. Copies would all draw the same part, hence the numbered chunks.
    """
    size = F.greatest(F.lit(COPIES_PER_CHUNK), F.ceil(F.col("copies") / MAX_CHUNKS))
    chunk = F.posexplode(F.array_repeat(F.lit(0), F.ceil(F.col("copies") / F.col("size")).cast("int")))
    exact = [F.col(c).cast("string").alias(c) if kind in ("float", "double") else F.col(c) for c, kind in rows.dtypes]
    floats = {c: kind for c, kind in rows.dtypes if kind in ("float", "double")}
    return (
        rows.groupBy(*exact)
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumns({c: F.col(c).cast(kind) for c, kind in floats.items()})
        .withColumn("size", size)
        .select("*", chunk.alias("chunk", "_"))
        .withColumn(weight, F.least(F.col("size"), F.col("copies") - F.col("chunk") * F.col("size")).cast("int"))
        .withColumn(part, F.pmod(F.xxhash64(*rows.columns, "chunk"), F.col(parts)).cast("int"))
        .drop("copies", "size", "chunk", "_")
    )


def every_part(parts: str) -> Column:
    """All part numbers of the other side, for the side that has to meet each of them."""
    return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))


def spread_weight(rows: DataFrame, weight: str) -> DataFrame:
    """One row per copy again."""
    return rows.withColumn(weight, F.explode(F.sequence(F.lit(1), F.col(weight)))).drop(weight)
