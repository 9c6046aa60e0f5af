"""Runs that become visible all at once.

A run writes its rows aside, into a folder of its own, and one record in a log makes them count. A record
is one file, so it is there or not; what a broken run has left is never read. One writer per log.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.schemas import COMMIT, Columns, ddl
from tramline.sources.tables import read_table


def stored_or_empty(spark: SparkSession, path: str, columns: Columns) -> DataFrame:
    """A table, without rows if it was never written."""
    try:
        return read_table(spark, path, columns=columns)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl(columns))


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of any file system Spark reaches; False if there was none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def new_run(label: str) -> str:
    """A name no other run has, sorting by its label."""
    return f"{label}-{uuid.uuid4().hex[:12]}"


class CommitLog:
    """The committed runs of a table, in order; each names what it took in and which runs it replaces."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def records(self) -> DataFrame:
        return stored_or_empty(self.spark, self.path, COMMIT)

    def runs(self) -> list[str]:
        """Committed runs that no later one replaces, oldest first; a row per run reaches the driver."""
        rows = self.records().select("number", "run", "replaces").collect()
        gone = {run for row in rows for run in row["replaces"]}
        return [row["run"] for row in sorted(rows) if row["run"] not in gone]

    def items(self) -> DataFrame:
        """run, item for everything that committed runs took in."""
        return self.records().select("run", F.explode("items").alias("item"))

    def commit(self, run: str, items: Iterable[str] = (), replaces: Iterable[str] = ()) -> None:
        last = self.records().agg(F.max("number")).first()[0] or 0
        row = (last + 1, run, list(items), list(replaces))
        self.spark.createDataFrame([row], ddl(COMMIT)).coalesce(1).write.mode("append").parquet(self.path)


def new_files(rows: DataFrame, log: CommitLog) -> list[str]:
    """Files of a stored table that no committed run has taken in, in order.

    The driver's own listing of the table names all its files; only the new ones are collected.
    """
    names = [(unquote(name),) for name in rows.inputFiles()]  # listed as URLs, read as paths
    listed = log.spark.createDataFrame(names, "item string")
    return sorted(row["item"] for row in listed.join(log.items(), "item", "left_anti").collect())
