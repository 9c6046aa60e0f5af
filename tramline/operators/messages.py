"""Topic payloads: JSON text as bytes, one record per message, no key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.schemas import Columns, ddl


def encode(records: DataFrame) -> DataFrame:
    """Whole record as UTF-8 JSON, nulls written out."""
    text = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return records.select(text.cast("binary").alias("value"))


def decode(messages: DataFrame, columns: Columns) -> DataFrame:
    """Typed columns of each message under a fixed schema.

    A message that is no JSON object becomes an all-null row and a badly typed field a null, so
    that one bad message never stops a stream. The key filter of the silver layer removes them.
    """
    parsed = F.from_json(F.col("value").cast("string"), ddl(columns))
    return messages.select(parsed.alias("record")).select("record.*")


def stamp_ingest(records: DataFrame, clock: Column | None = None) -> DataFrame:
    """Add ``ingested_at``: the processing time, or a column for a replay that must be repeatable."""
    return records.withColumn("ingested_at", F.current_timestamp() if clock is None else clock)
