"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.session import run_dir

# A word is a run of anything but these characters. The same set is what ``bytes.split()`` splits on.
BLANKS = " \t\n\x0b\x0c\r"
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
GAP = r"[\x20\x09-\x0D]+"


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Words of a text in order; a null text has none."""
    return F.array_remove(F.split(text_or_empty(text), GAP, -1), "")


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(divisor)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared work folder and read it again.

    Cuts the lineage: the rows, row numbers included, are the same for every later reader,
    whichever executors are lost meanwhile.
    """
    spark = df.sparkSession
    path = run_dir(spark, f"llm-{name}")
    # The files of its shuffles go with the end of this write, not when the driver's garbage happens to be collected.
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def texts_at_once(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within, tasks hand at most ``rows`` rows at a time to Python, so that neither side holds a whole file of texts."""
    before = spark.conf.get(BATCH, None)
    most = int(before or 0)  # none set, or no limit
    spark.conf.set(BATCH, str(min(rows, most) if most > 0 else rows))
    try:
        yield
    finally:
        spark.conf.unset(BATCH) if before is None else spark.conf.set(BATCH, before)


def deleted(*tables: DataFrame) -> None:
    """Remove staged tables that nothing reads any more."""
    for df in tables:
        jvm, session = df.sparkSession._jvm, df.sparkSession._jsparkSession
        for name in {file.rpartition("/")[0] for file in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(session.sessionState().newHadoopConf()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
