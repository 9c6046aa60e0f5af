"""Raw topics: a message queue, or a folder of files with one ``value`` column standing in for it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.schemas import RAW_MESSAGE, ddl

# Source options of the two topics. The positions stream fails when the queue has
# already dropped messages it never read; the updates stream carries on.
POSITIONS_OPTIONS = {"startingOffsets": "earliest"}
UPDATES_OPTIONS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}


def read_topic(
    spark: SparkSession, topic: str, fmt: str = "kafka", servers: str | None = None, options: dict | None = None
) -> DataFrame:
    """Unbounded messages with a binary ``value``.

    ``topic`` is a topic name for ``kafka`` and a folder for a file format. Starting offsets only
    matter for a query without a checkpoint.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        return reader.load().select("value")
    if fmt == "text":
        return reader.load(topic).select(F.col("value").cast("binary"))
    return reader.schema(ddl(RAW_MESSAGE)).load(topic)


def write_topic(messages: DataFrame, topic: str, fmt: str = "kafka", servers: str | None = None) -> None:
    """Append a batch of messages."""
    if fmt == "kafka":
        messages.write.format(fmt).option("kafka.bootstrap.servers", servers).option("topic", topic).save()
        return
    if fmt == "text":
        messages = messages.select(F.col("value").cast("string"))
    messages.write.format(fmt).mode("append").save(topic)
