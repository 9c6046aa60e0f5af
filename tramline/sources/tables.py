"""Lake tables in a format of the caller's choice (``parquet``, ``delta`` and so on)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tramline.schemas import Columns, ddl

FIFTEEN_SECONDS = {"processingTime": "15 seconds"}
TWO_MINUTES = {"processingTime": "2 minutes"}
UNTIL_DRAINED = {"availableNow": True}


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", columns: Columns | None = None) -> DataFrame:
    """A stored table; given columns also make a folder readable that has no files yet."""
    reader = spark.read.format(fmt)
    if columns and fmt != "delta":
        reader = reader.schema(ddl(columns))
    return reader.load(path)


def stream_table(
    spark: SparkSession, path: str, columns: Columns, fmt: str = "parquet", options: dict | None = None
) -> DataFrame:
    """Table rows as a stream. Plain files need the schema; a table format brings its own."""
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt != "delta":
        reader = reader.schema(ddl(columns))
    return reader.load(path)


def with_source_row(rows: DataFrame) -> DataFrame:
    """Tell exact copies apart by where they are stored, which a recomputed task sees the same."""
    return rows.withColumn("source_row", F.xxhash64("_metadata.file_path", "_metadata.row_index"))


def write_table(
    rows: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    rows.write.format(fmt).mode(mode).partitionBy(*partition_by).save(path)


def append_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    trigger: dict | None = None,
    partition_by: Sequence[str] = (),
) -> DataStreamWriter:
    """Append-only table sink, ready to start. Each query needs its own checkpoint folder."""
    writer = (
        rows.writeStream.format(fmt).outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(**trigger) if trigger else writer
