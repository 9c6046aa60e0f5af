"""Facts that come before their dimension rows: held back until every parent is there, or given inferred parents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.operators.lookup import lookup
from tramline.operators.quality import fk_orphans
from tramline.plans.dimensions import DimensionTable
from tramline.schemas import FOREIGN_KEYS, WAREHOUSE, ddl
from tramline.sources.commits import CommitLog, new_run
from tramline.sources.tables import read_table

FACT_TABLE = "fact_stop_delay"


def parents_of(child: str, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Foreign key column of ``child`` to the given parent table."""
    return {column: tables[parent] for table, column, parent in FOREIGN_KEYS if table == child and parent in tables}


def with_missing(rows: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """``rows`` with ``missing``: the foreign key columns, in order, whose value has no parent row.

    A null refers to nothing and misses nothing. Parents may repeat their key.
    """
    marked = rows
    for column, parent in parents.items():
        known = parent.select(column).filter(F.col(column).isNotNull()).distinct().withColumn(f"has_{column}", F.lit(True))
        marked = lookup(marked, known, [column], measured=rows.select(column))
    lacks = [F.when(F.col(c).isNotNull() & F.col(f"has_{c}").isNull(), F.lit(c)) for c in parents]
    missing = F.array_compact(F.array(*lacks)) if lacks else F.array().cast("array<string>")
    return marked.select(*rows.columns, missing.alias("missing"))


class HeldFacts:
    """Fact rows that passed the foreign key check, and those that wait for a parent.

    Each load takes what is new and what waits, checks it against the dimensions as they are now, and writes
    both outcomes aside; one record makes them count. So a row is in exactly one of the two tables, a broken
    load leaves none of its rows, and a load run again under its number is not taken twice.
    """

    def __init__(self, spark: SparkSession, path: str, table: str = FACT_TABLE) -> None:
        self.spark, self.path, self.table = spark, path, table
        self.log = CommitLog(spark, f"{path}/log")

    def _read(self, part: str, runs: list[str], more: dict[str, str]) -> DataFrame:
        columns = {**WAREHOUSE[self.table], **more}
        if not runs:
            return self.spark.createDataFrame([], ddl(columns))
        stored = read_table(self.spark, f"{self.path}/{part}", columns={**columns, "run": "string"})
        return stored.filter(F.col("run").isin(runs)).select(*columns)

    def passed(self) -> DataFrame:
        """All rows whose parents are there, with the load that let them pass."""
        return self._read("passed", self.log.runs(), {"passed_in": "string"})

    def held(self) -> DataFrame:
        """The rows that wait, with the keys they lack and the load that brought them."""
        return self._read("held", self.log.runs()[-1:], {"missing": "array<string>", "held_since": "string"})

    def load(self, rows: DataFrame, dims: dict[str, DataFrame], load_number: str) -> bool:
        """Take in new fact rows and let pass what can; returns whether the load was new."""
        if self.log.items().filter(F.col("item") == load_number).count():
            return False
        fresh = rows.select(*WAREHOUSE[self.table]).withColumn("held_since", F.lit(load_number))
        waiting = fresh.unionByName(self.held().drop("missing"))
        run = new_run(load_number)
        # Checked once, written aside, then dealt to the two tables.
        checked = f"{self.path}/checked/run={run}"
        with_missing(waiting, parents_of(self.table, dims)).write.parquet(checked)
        rows = self.spark.read.parquet(checked)
        ready = F.size("missing") == 0
        passing = rows.filter(ready).drop("missing", "held_since").withColumn("passed_in", F.lit(load_number))
        passing.write.parquet(f"{self.path}/passed/run={run}")
        rows.filter(~ready).write.parquet(f"{self.path}/held/run={run}")
        self.log.commit(run, [load_number])
        return True


def infer_members(
    dim: DimensionTable, rows: DataFrame, load_number: str, now: Column | None = None
) -> bool:
    """Give every value of ``rows`` that refers to nothing a parent of its key alone in the dimension's history.

    When the real row comes, a merge gives the key a new row; ``created_at`` stays that of the inferred one.
    References are counted per value before they meet the dimension, so a hot one is a single row.
    """
    (key,) = dim.keys
    orphans = fk_orphans(rows, key, dim.current().select(key))
    return dim.merge(orphans.select(key), f"{load_number}-inferred", now, complete=False)
