"""What a stream lost to its watermark is found by accounts and put back.

The stream drops rows that come after its watermark, and never emits positions without a time. The account
of its fact, kept up file by file, is held against the account of the batch join. Windows that differ are
joined again, those alone, and written aside; one record makes them count instead of the stream's rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.functions import from_epoch
from tramline.operators.account import NO_TIME, PLACE, WINDOW_SECONDS, account, cell, differing, merged, placed, window
from tramline.operators.fact import BOUND_SECONDS, build_fact
from tramline.plans.fact import fact_of_days, second_of
from tramline.schemas import ACCOUNT, BRONZE_TRIP_UPDATE, FACT, LOST_WINDOW, VEHICLE_POSITION, ddl
from tramline.sources.commits import CommitLog, new_files, new_run, stored_or_empty
from tramline.sources.tables import read_table

RUN = {"run": "string"}


class RepairedFact:
    """The stream's fact under ``silver_dir`` with the windows that were put right since."""

    def __init__(self, spark: SparkSession, silver_dir: str) -> None:
        self.spark = spark
        self.fact = f"{silver_dir}/fact"
        self.path = f"{silver_dir}/fact_repairs"
        self.counted = CommitLog(spark, f"{self.path}/counted")
        self.repaired = CommitLog(spark, f"{self.path}/repaired")

    def _stream(self) -> DataFrame:
        return stored_or_empty(self.spark, self.fact, FACT)

    def take_in(self, label: str = "count") -> int:
        """Account for the stream's new files; returns their number."""
        fresh = new_files(self._stream(), self.counted)
        if fresh:
            run = new_run(label)
            rows = self.spark.read.schema(ddl(FACT)).option("basePath", self.fact).parquet(*fresh)
            account(rows).write.parquet(f"{self.path}/accounts/run={run}")
            self.counted.commit(run, fresh)
        return len(fresh)

    def _of_runs(self, name: str, columns: dict[str, str], log: CommitLog) -> DataFrame:
        """Rows of committed runs, with the run."""
        stored = stored_or_empty(self.spark, f"{self.path}/{name}", {**columns, **RUN})
        return stored.filter(F.col("run").isin(log.runs()))

    def _owners(self) -> DataFrame:
        """cell, window, run of every window put right, by its last repair."""
        order = self.spark.createDataFrame(list(enumerate(self.repaired.runs())), "turn long, run string")
        windows = self._of_runs("windows", LOST_WINDOW, self.repaired).join(F.broadcast(order), "run")  # a row per repair
        last = windows.groupBy(*PLACE).agg(F.max(F.struct("turn", "run")).alias("last"))
        return last.select(*PLACE, "last.run")

    def _repairs(self) -> DataFrame:
        """The repaired rows that count, with their cell and window."""
        rows = self._of_runs("rows", {**FACT, "cell": "int", "window": "bigint"}, self.repaired)
        return rows.join(self._owners(), [*PLACE, "run"], "left_semi").drop("run")

    def read(self) -> DataFrame:
        """The fact: the stream's rows, but in repaired windows those of the repair."""
        if not self.repaired.runs():
            return self._stream().select(*FACT)
        kept = placed(self._stream()).join(self._owners().select(*PLACE), PLACE, "left_anti")
        return kept.select(*FACT).unionByName(self._repairs().select(*FACT))

    def given(self) -> DataFrame:
        """The account of what ``read`` gives; of the stream's files only new ones are read."""
        self.take_in()
        stream = merged(self._of_runs("accounts", ACCOUNT, self.counted).select(*ACCOUNT))
        if not self.repaired.runs():
            return stream
        kept = stream.join(self._owners().select(*PLACE), PLACE, "left_anti")
        return kept.unionByName(account(self._repairs().select(*FACT)))

    def lost(
        self, bronze_dir: str, bound: int = BOUND_SECONDS, first: date | None = None, last: date | None = None
    ) -> DataFrame:
        """The windows whose rows are not those of the batch join, by UTC days of positions if given.

        Ask for days that the watermark has passed: the stream may still have to emit rows of others.
        """
        expected = account(fact_of_days(*self._bronze(bronze_dir), bound, first, last))
        return differing(expected, self.given().filter(_in_days(first, last)))

    def _bronze(self, bronze_dir: str) -> tuple[DataFrame, DataFrame]:
        return (
            read_table(self.spark, f"{bronze_dir}/vehicle_positions", columns=VEHICLE_POSITION),
            read_table(self.spark, f"{bronze_dir}/trip_updates", columns=BRONZE_TRIP_UPDATE),
        )

    def repair(
        self, bronze_dir: str, bound: int = BOUND_SECONDS, first: date | None = None, last: date | None = None
    ) -> DataFrame:
        """Put right the windows that differ; returns them. Without any nothing is written but their list."""
        run = new_run("repair")
        windows = f"{self.path}/windows/run={run}"
        self.lost(bronze_dir, bound, first, last).write.parquet(windows)
        wrong = read_table(self.spark, windows, columns=LOST_WINDOW)
        if wrong.isEmpty():
            return wrong
        positions, updates = self._bronze(bronze_dir)
        rows = build_fact(_in_windows(positions, wrong), _near_windows(updates, wrong, bound), bound)
        placed(rows).write.parquet(f"{self.path}/rows/run={run}")
        self.repaired.commit(run)
        return wrong


def _in_days(first: date | None, last: date | None) -> Column:
    """Whether a window lies between two days, both included; that of no time lies between none."""
    number, inside = F.col("window"), F.lit(True)
    if first is not None or last is not None:
        inside = number != NO_TIME
    if first is not None:
        inside &= number >= second_of(first) // WINDOW_SECONDS
    if last is not None:
        inside &= number < (second_of(last) + 86_400) // WINDOW_SECONDS
    return inside


def _in_windows(positions: DataFrame, windows: DataFrame) -> DataFrame:
    """Positions of some windows."""
    at = from_epoch(F.col("vehicle_timestamp"))
    own = positions.withColumns({"cell": cell(), "window": window(at)})
    return own.join(windows.select(*PLACE), PLACE, "left_semi").drop(*PLACE)


def _near_windows(updates: DataFrame, windows: DataFrame, bound: int) -> DataFrame:
    """Updates in the windows from which a position of some windows can be reached; each once."""
    reach = -(-bound // WINDOW_SECONDS)
    around = F.explode(F.sequence(F.col("window") - reach, F.col("window") + reach)).alias("window")
    wanted = windows.select("cell", around).distinct()
    own = updates.withColumns({"cell": cell(), "window": window(F.col("ingested_at"))})
    return own.join(wanted, PLACE, "left_semi").drop(*PLACE)
