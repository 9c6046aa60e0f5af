"""Star dimensions that outlast a load: history merged into a new version, which then takes the old one's place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.operators.history import STAMPS, merge_history
from tramline.schemas import PRIMARY_KEYS, WAREHOUSE, Columns, ddl
from tramline.sources.commits import CommitLog, new_run, remove_folder
from tramline.sources.tables import read_table


class DimensionTable:
    """The history of a declared dimension under ``star_dir``.

    A load writes all rows as a new version and commits it; readers see the last committed one. So a load
    that breaks changes nothing, and one that is run again under its load number is not merged twice.
    """

    def __init__(self, spark: SparkSession, star_dir: str, table: str) -> None:
        self.spark, self.table = spark, table
        self.path = f"{star_dir}/{table}_history"
        self.log = CommitLog(spark, f"{self.path}/log")
        self.keys = PRIMARY_KEYS[table]
        self.columns: Columns = {c: kind for c, kind in WAREHOUSE[table].items() if c not in STAMPS}

    def _version(self, run: str) -> str:
        return f"{self.path}/data/version={run}"

    def history(self) -> DataFrame:
        """All rows of the last version, none before the first."""
        runs, columns = self.log.runs(), {**self.columns, **STAMPS}
        if not runs:
            return self.spark.createDataFrame([], ddl(columns))
        return read_table(self.spark, self._version(runs[-1]), columns=columns)

    def current(self) -> DataFrame:
        """The declared table: a row per key that is not gone."""
        return self.history().filter("valid_to IS NULL").select(*WAREHOUSE[self.table])

    def merge(self, incoming: DataFrame, load_number: str, now: Column | None = None, complete: bool = True) -> bool:
        """Merge a load; returns whether it was new. Columns ``incoming`` lacks are null."""
        if self.log.items().filter(F.col("item") == load_number).count():
            return False
        conformed = incoming.select(
            *((F.col(c) if c in incoming.columns else F.lit(None)).try_cast(kind).alias(c) for c, kind in self.columns.items())
        )
        stamp = F.current_timestamp() if now is None else now
        rows = merge_history(self.history(), conformed, self.keys, stamp, load_number, complete)
        run, before = new_run(load_number), self.log.runs()
        rows.write.parquet(self._version(run))
        self.log.commit(run, [load_number], before)
        return True

    def drop_versions(self) -> list[str]:
        """Remove the folders of versions that a later one replaced, for when no reader is left on them."""
        runs = set(self.log.runs())
        gone = [row["run"] for row in self.log.records().select("run").collect() if row["run"] not in runs]
        return [run for run in gone if remove_folder(self.spark, self._version(run))]
