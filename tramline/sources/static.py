"""Static schedule files and nested feed snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tramline.schemas import FEED_SNAPSHOT


def read_schedule_file(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """CSV with a header, every column as text; a quote inside a quoted field is doubled.

    Line breaks inside fields are only read with ``multi_line``, which costs the ability to split
    a file between tasks.
    """
    return spark.read.options(header=True, escape='"', multiLine=multi_line, inferSchema=False).csv(path)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Decoded feed snapshots, one JSON document per line."""
    return spark.read.schema(FEED_SNAPSHOT).json(path)


def stream_snapshots(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(FEED_SNAPSHOT).json(path)
