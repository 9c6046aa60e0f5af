"""Run audit: what was loaded, how many rows, when, and whether it worked."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tramline.schemas import WAREHOUSE, ddl


# Seconds that the count of a finished write may take to arrive.
COUNT_WAIT = 60.0


def _arrived(counted: Observation, wait: float) -> int | None:
    """The observed count; None if the write began no action on the rows, or on rows known to be none."""
    found: list[int] = []

    def get() -> None:
        try:
            found.append(counted.get["row_count"])
        except Exception:  # an observation of rows that were optimised away has no values
            pass

    waiting = threading.Thread(target=get, daemon=True)
    waiting.start()
    waiting.join(wait)
    return found[0] if found else None


class AuditedRun:
    """One write of one table. Rows are counted by the write itself, not by a second job.

    Only where no count arrives are the rows counted again: if there are none, that is the result,
    otherwise the write did not act on the rows it was given, and the run has failed.
    """

    def __init__(self, load_number: str, layer: str) -> None:
        self.load_number = load_number
        self.layer = layer
        self.status: str | None = None
        self.row_count: int | None = None
        self.start_time: datetime | None = None
        self.end_time: datetime | None = None

    def write(self, rows: DataFrame, write: Callable[[DataFrame], None], wait: float = COUNT_WAIT) -> None:
        """Run a write; a failure is recorded and raised again. ``wait`` limits how long the count may take."""
        counted = Observation()
        self.start_time = datetime.now(timezone.utc)
        try:
            write(rows.observe(counted, F.count(F.lit(1)).alias("row_count")))
            count = _arrived(counted, wait)
            if count is None:
                if not rows.isEmpty():
                    raise RuntimeError("the write started no action on the rows it was given")
                count = 0
            self.row_count = count
            self.status = "SUCCESS"
        except Exception:
            self.status = "FAILED"
            raise
        finally:
            self.end_time = datetime.now(timezone.utc)


def audit_rows(spark: SparkSession, runs: Iterable[AuditedRun]) -> DataFrame:
    """Rows of ``audit_pipeline_runs``, one per run; the key is stable for a run."""
    fields = ("load_number", "layer", "status", "row_count", "start_time", "end_time")
    columns = {name: WAREHOUSE["audit_pipeline_runs"][name] for name in fields}
    rows = spark.createDataFrame([tuple(getattr(run, name) for name in fields) for run in runs], ddl(columns))
    return rows.withColumn("run_id", F.xxhash64("load_number", "layer", "start_time")).select(
        *WAREHOUSE["audit_pipeline_runs"]
    )
