"""Key checks of the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pk_violations(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def fk_orphans(child: DataFrame, column: str, parent: DataFrame) -> DataFrame:
    """Non-null references without a parent row, with the number of child rows holding each.

    References are counted before the anti join, so a hot one takes part as a single row.
    """
    references = (
        child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    )
    return references.join(parent.select(column), column, "left_anti")
