"""Exact duplicates: heavy digests are found by a Misra-Gries sketch and leave before the shuffle (native).

A digest that a large share of rows carries would make one reducer hold all of them. The sketch
names every digest above a share of the rows; an exact count of those alone, combined map-side,
confirms them and finds the row of each that stays. The few winners are broadcast, so rows of a heavy
digest are settled where they are read. All other digests are grouped by an ordinary shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tramline.llm.common import BLANKS, staged, table, text_or_empty

# Digests the sketch tracks, and how many of them at most are counted exactly and broadcast. A digest
# on more than about one row in TRACKED is always among them.
TRACKED = 16_384
HEAVY = 1_024
# A digest on fewer rows than this is no burden to a reducer.
HEAVY_ROWS = 32


def normalised(text: Column) -> Column:
    """The text without blanks; a null text is empty."""
    return F.translate(text_or_empty(text), BLANKS, "")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def _rank(length: str, doc_id: str) -> Column:
    """Smallest for the row that stays: longest text, then smallest id, a null id last."""
    return F.struct((-F.col(length)).alias("l"), F.col(doc_id).isNull().alias("n"), F.col(doc_id).alias("d"))


def heavy_digests(rows: DataFrame, tracked: int = TRACKED, heavy: int = HEAVY, least: int = HEAVY_ROWS) -> DataFrame:
    """digest, heavy_size, heavy_rank of at most ``heavy`` digests that occur ``least`` times or more.

    ``rows`` has digest, length, doc_id. The sketch (Misra-Gries counters with purging) is built per
    task and merged, so it is bounded whatever the input; what it names is counted exactly.
    """
    named = rows.select(F.xxhash64("digest").alias("item")).agg(
        F.expr(f"approx_top_k(item, {heavy}, {tracked})").alias("top")
    )
    named = named.select(F.explode("top.item").alias("item"))
    return (
        rows.withColumn("item", F.xxhash64("digest"))
        .join(F.broadcast(named), "item", "left_semi")  # at most ``heavy`` numbers
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("heavy_size"), F.min(_rank("length", "doc_id")).alias("heavy_rank"))
        .filter(F.col("heavy_size") >= least)
    )


def exact_groups(docs: DataFrame, tracked: int = TRACKED, heavy: int = HEAVY, least: int = HEAVY_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical without blanks; null counts as empty. Of equal texts the
    longest original stays, then the smallest doc_id, a null doc_id last; among rows that repeat that
    doc_id as well, one. Other columns of ``docs`` are ignored. An empty table gives no rows.
    """
    text = text_or_empty(docs["text"])
    hashed = docs.select("doc_id", F.length(text).alias("length"), digest(docs["text"]).alias("digest"))
    rows = staged(hashed, "digests")  # texts are read once; the three passes below read this
    winners = staged(heavy_digests(rows, tracked, heavy, least), "heavy")
    marked = rows.join(F.broadcast(winners), "digest", "left")  # at most ``heavy`` rows

    hot = marked.filter(F.col("heavy_size").isNotNull())
    is_rank = _rank("length", "doc_id") == F.col("heavy_rank")
    # One row per heavy digest, unless a doc_id is repeated; only these meet again.
    first = F.row_number().over(W.partitionBy("digest").orderBy("doc_id")) == 1
    settled = hot.filter(is_rank).withColumn("kept", first).unionByName(hot.filter(~is_rank).withColumn("kept", F.lit(False)))
    settled = settled.select("doc_id", "digest", "kept", F.col("heavy_size").alias("size"), F.col("heavy_rank.d").alias("keep_id"))

    group = W.partitionBy("digest")
    order = group.orderBy(_rank("length", "doc_id"))
    rest = marked.filter(F.col("heavy_size").isNull()).select(
        "doc_id",
        "digest",
        (F.row_number().over(order) == 1).alias("kept"),
        F.count(F.lit(1)).over(group).alias("size"),
        F.first("doc_id").over(order).alias("keep_id"),
    )
    return settled.unionByName(rest).select(
        "doc_id", "keep_id", F.col("size").alias("group_size"), "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def drop_copies(docs: DataFrame, tracked: int = TRACKED, heavy: int = HEAVY, least: int = HEAVY_ROWS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, by the rules of ``exact_groups``."""
    work = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id"),
        F.length(text_or_empty(docs["text"])).alias("length"),
        digest(docs["text"]).alias("digest"),
    )
    small = staged(work.select("digest", "length", "doc_id"), "digests")
    winners = staged(heavy_digests(small, tracked, heavy, least), "heavy")
    marked = work.join(F.broadcast(winners.drop("heavy_size")), "digest", "left")
    # Of a heavy digest only the row that stays goes on; a repeated doc_id is settled with the rest.
    left = marked.filter(F.col("heavy_rank").isNull() | (_rank("length", "doc_id") == F.col("heavy_rank")))
    order = W.partitionBy("digest").orderBy(_rank("length", "doc_id"))
    return left.withColumn("n", F.row_number().over(order)).filter("n = 1").select("row.*")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP6_SQL = r"""
WITH h AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER o AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER o = 1 AS kept, text_sha256
FROM h WINDOW o AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)
"""
