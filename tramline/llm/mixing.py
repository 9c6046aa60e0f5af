"""Mixing sources to target weights by blocks of words.

The words of each source, in a fixed order of its documents, form blocks of equal length. Each output
shard draws how many blocks it takes from which source from a multinomial distribution. The slots a
source got are numbered, and a pseudorandom permutation of its block numbers, another one for each
pass over the source, says which block a slot takes. Slots and documents then meet in a join on the
block number; no generator state is passed between tasks, so a recomputed task draws the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tramline.llm.common import staged, table, text_or_empty, words

BLOCK_WORDS = 256
SLOTS_PER_SHARD = 16_384
# Most repeats of a source.
REPEATS = 3
# Documents whose places are summed up in one task.
ROWS_PER_BUCKET = 8_192
# The mixture's probabilities are one vector per task. More sources than this are refused.
MAX_SOURCES = 100_000
SEED = 1234
ROUNDS = 4


def weigh(names: Sequence[str | None]) -> list[float]:
    """Weights of the sources in order: 1, 2, 3, repeating."""
    return [float(i % 3 + 1) for i in range(len(names))]


def shares(sizes: np.ndarray, weights: np.ndarray, total: float, repeats: int = REPEATS) -> np.ndarray:
    """``total`` divided by weight; what is above ``repeats`` times a size goes to the others by weight."""
    caps, targets, open_ = sizes * float(repeats), np.zeros(len(sizes)), np.ones(len(sizes), bool)
    left = float(total)
    while open_.any():
        targets[open_] = left * weights[open_] / weights[open_].sum()
        above = open_ & (targets > caps)
        if not above.any():
            break
        targets[above] = caps[above]
        open_ &= ~above
        left = total - targets[~open_].sum()
    return targets


def _mix(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of each number."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def permuted(places: np.ndarray, count: int, keys: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Image of each place under a permutation of 0..count-1 that its key selects.

    A Feistel network permutes the next power of four; images outside are sent through it again.
    """
    half = np.uint64(max(1, (max(count - 1, 1).bit_length() + 1) // 2))
    low = np.uint64((1 << int(half)) - 1)
    out, todo = places.astype(np.uint64), np.ones(len(places), bool)
    while todo.any():
        x, k = out[todo], keys[todo]
        left, right = x >> half, x & low
        for r in range(ROUNDS):
            with np.errstate(over="ignore"):
                turn = k + np.uint64((ROUNDS - 1 - r if inverse else r) + 1) * np.uint64(0x9E3779B97F4A7C15)
            if inverse:
                left, right = right ^ (_mix(left ^ turn) & low), left
            else:
                left, right = right, left ^ (_mix(right ^ turn) & low)
        out[todo] = (left << half) | right
        todo[todo] = out[todo] >= count
    return out.astype(np.int64)


def _keys(seed: int, source: int, passes: np.ndarray) -> np.ndarray:
    base = _mix(np.array([seed * 1_000_003 + source], np.uint64))[0]
    return _mix(base ^ passes.astype(np.uint64))


@dataclass(frozen=True)
class Plan:
    """What is known of each source, by its number: arrays of equal length."""

    names: list
    sizes: np.ndarray
    targets: np.ndarray
    blocks: np.ndarray
    slots: np.ndarray  # slots that fill the target
    cut: np.ndarray  # words that the last slot takes
    block_words: int
    seed: int

    @property
    def total(self) -> int:
        return int(self.slots.sum())


def make_plan(names: Sequence, sizes: Sequence[int], weights: Sequence[float], block: int, repeats: int, seed: int) -> Plan:
    size = np.array(sizes, np.int64)
    targets = shares(size.astype(float), np.array(weights, float), float(size.sum()), repeats)
    blocks = -(-size // block)
    slots, cut = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
    for s in np.flatnonzero(size):
        want = min(int(round(targets[s])), repeats * int(size[s]))
        passes, rest = divmod(want, int(size[s]))
        n, missing = int(blocks[s]), int(blocks[s] * block - size[s])
        # The source's last block is short. Where it stands in the last pass decides how many slots are needed.
        short = int(permuted(np.array([n - 1]), n, _keys(seed, int(s), np.array([passes])), inverse=True)[0])
        before = lambda i, short=short, missing=missing: i * block - missing * (i > short)
        m = -(-rest // block)
        m += before(m) < rest
        slots[s] = passes * n + m
        cut[s] = rest - before(m - 1) if m else block
    return Plan(list(names), size, targets, blocks, slots, cut, block, seed)


def _drawn(plan: Plan, shard_slots: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    total = plan.total
    odds = plan.slots / total

    def draw(frames):
        for frame in frames:
            for shard in frame["id"]:
                size = min(shard_slots, total - int(shard) * shard_slots)
                rng = np.random.Generator(np.random.Philox(key=[plan.seed, int(shard)]))
                counts = rng.multinomial(size, odds)
                some = np.flatnonzero(counts)
                yield pd.DataFrame({"shard": shard, "source_no": some, "count": counts[some]})

    return draw


def _settled(plan: Plan, drawn: np.ndarray) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Slots of each shard and source as blocks; slots beyond a source's need go to sources that drew too few."""
    over, under = np.maximum(drawn - plan.slots, 0), np.maximum(plan.slots - drawn, 0)
    over_before = np.concatenate([[0], np.cumsum(over)[:-1]])
    under_ends = np.cumsum(under)

    def settle(frames):
        for frame in frames:
            for shard, source, before, count in frame[["shard", "source_no", "before", "count"]].itertuples(index=False):
                number = np.arange(before, before + count)
                owner = np.full(count, source)
                spare = number >= plan.slots[source]
                if spare.any():
                    index = over_before[source] + number[spare] - plan.slots[source]
                    owner[spare] = np.searchsorted(under_ends, index, side="right")
                    number[spare] = drawn[owner[spare]] + index - (under_ends - under)[owner[spare]]
                for s in np.unique(owner):
                    own = number[owner == s]
                    n = int(plan.blocks[s])
                    passes = own // n
                    yield pd.DataFrame(
                        {
                            "shard": shard,
                            "source_no": s,
                            "slot": own,
                            "pass": passes,
                            "block": permuted(own % n, n, _keys(plan.seed, int(s), passes)),
                            "take": np.where(own == plan.slots[s] - 1, plan.cut[s], plan.block_words),
                        }
                    )

    return settle


def slots_to_blocks(spark: SparkSession, plan: Plan, shard_slots: int = SLOTS_PER_SHARD) -> DataFrame:
    """shard, source_no, slot, pass, block, take: one row per slot of the mixture."""
    schema = "shard long, source_no long, slot long, pass long, block long, take long"
    if not plan.total:
        return spark.createDataFrame([], schema)
    shards = -(-plan.total // shard_slots)
    draws = spark.range(shards).mapInPandas(_drawn(plan, shard_slots), "shard long, source_no long, count long")
    drawn = np.zeros(len(plan.names), np.int64)
    for row in draws.groupBy("source_no").agg(F.sum("count").alias("n")).collect():  # a row per source
        drawn[row["source_no"]] = row["n"]
    order = W.partitionBy("source_no").orderBy("shard")
    before = F.sum("count").over(order) - F.col("count")
    return draws.withColumn("before", before).mapInPandas(_settled(plan, drawn), schema)


def _measured(docs: DataFrame) -> DataFrame:
    """doc_id, key, rep, source, size of every row; key and rep name a row whatever its doc_id."""
    text = text_or_empty(docs["text"])
    sized = docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.xxhash64("doc_id", text).alias("key"),
        F.size(words(docs["text"])).cast("long").alias("size"),
    )
    return sized.withColumn("rep", F.row_number().over(_same()))


def _same() -> W:
    return W.partitionBy("key").orderBy("doc_id", "source", "size")


def _pieces(rows: DataFrame, block: int, count: int) -> DataFrame:
    """Parts of documents by block: key, rep, doc_id, source_no, block, at, start, length.

    Places within a source are sums over the documents before, by bucket and then within it, so that
    a large source is summed in many tasks.
    """
    buckets = max(1, -(-count // ROWS_PER_BUCKET))
    rows = rows.filter("size > 0").withColumn("bucket", F.pmod("key", F.lit(buckets)))
    sums = rows.groupBy("source_no", "bucket").agg(F.sum("size").alias("n"))
    over = W.partitionBy("source_no").orderBy("bucket")
    starts = sums.select("source_no", "bucket", (F.sum("n").over(over) - F.col("n")).alias("bucket_start"))
    inside = W.partitionBy("source_no", "bucket").orderBy("key", "rep").rowsBetween(W.unboundedPreceding, 0)
    placed = rows.withColumn("end", F.sum("size").over(inside)).join(starts, ["source_no", "bucket"])
    first = F.col("bucket_start") + F.col("end") - F.col("size")
    placed = placed.select("doc_id", "key", "rep", "source_no", "size", first.alias("first"))
    last = F.col("first") + F.col("size") - 1
    cut = placed.withColumn("block", F.explode(F.sequence(F.expr(f"first div {block}"), F.floor(last / block).cast("long"))))
    start = F.greatest(F.col("block") * block - F.col("first"), F.lit(0))
    stop = F.least(F.col("block") * block + block - F.col("first"), F.col("size"))
    at = F.greatest(F.col("first") - F.col("block") * block, F.lit(0))
    return cut.select(
        "doc_id", "key", "rep", "source_no", "block", at.alias("at"), start.alias("start"), (stop - start).alias("length")
    )


@dataclass(frozen=True)
class Mixture:
    """The rows with their sizes, what each source shall give, and the parts of documents that were taken."""

    rows: DataFrame  # doc_id, key, rep, size, source, source_no
    sources: DataFrame  # source_no, source, source_size, target
    taken: DataFrame  # shard, slot, pass, key, rep, doc_id, start, length (in words of the document)


def mix(
    docs: DataFrame,
    weights: Callable[[Sequence], Sequence[float]] = weigh,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SLOTS_PER_SHARD,
    repeats: int = REPEATS,
    seed: int = SEED,
) -> Mixture:
    """Mix ``docs`` (doc_id, text, source) so that sources take their weights' share of all words.

    A source gives its target to the word, by whole passes over its blocks and one partial pass; no
    document gives more than ``repeats`` times its words. Null or empty texts have no words and give
    none; a null source is a source of its own, the last one. Repeated rows count each. Other columns
    are ignored. With no words at all nothing is taken. The result depends on rows and seed alone.

    Sources are held in the driver, a few numbers each; more than MAX_SOURCES raise an error.
    """
    spark = docs.sparkSession
    rows = staged(_measured(docs), "sizes")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows"))
    found = per_source.orderBy(F.col("source").asc_nulls_last()).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    names = [r["source"] for r in found]
    plan = make_plan(names, [r["n"] for r in found], weights(names), block_words, repeats, seed)
    sources = spark.createDataFrame(
        [(i, n, int(plan.sizes[i]), float(plan.targets[i])) for i, n in enumerate(names)],
        "source_no long, source string, source_size long, target double",
    )
    numbered = rows.join(F.broadcast(sources.select("source_no", F.col("source").alias("s"))), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    slots = slots_to_blocks(spark, plan, shard_slots)
    pieces = _pieces(numbered, block_words, sum(r["rows"] for r in found))
    # Slots come from a short list of shards, so the planner would take them for few and broadcast them.
    met = slots.hint("merge").join(pieces, ["source_no", "block"]).filter("take > at")
    taken = met.select(
        "shard", "slot", "pass", "key", "rep", "doc_id", "start", F.least(F.col("length"), F.col("take") - F.col("at")).alias("length")
    )
    return Mixture(numbered, sources, taken)


def mixed_docs(docs: DataFrame, **options) -> DataFrame:
    """The mixture as rows with the columns of ``docs``: one per run of words that a pass took.

    A text taken whole stays as it is; of others the words of the run are joined by blanks. ``n_chars``
    is counted anew where ``docs`` has it.
    """
    mixture = mix(docs, **options)
    inside = W.partitionBy("key", "rep", "pass").orderBy("start")
    gap = F.coalesce(F.lag(F.col("start") + F.col("length")).over(inside) != F.col("start"), F.lit(True))
    runs = mixture.taken.withColumn("run", F.sum(gap.cast("int")).over(inside))
    runs = runs.groupBy("key", "rep", "pass", "run").agg(F.min("start").alias("from"), F.sum("length").alias("words"))
    text = text_or_empty(docs["text"])
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.xxhash64("doc_id", text).alias("key"),
        docs["doc_id"],
        F.col("source").cast("string").alias("source"),
        F.size(words(docs["text"])).cast("long").alias("size"),
    ).withColumn("rep", F.row_number().over(_same()))
    joined = rows.join(runs, ["key", "rep"])
    part = F.array_join(F.slice(words(F.col("row.text")), (F.col("from") + 1).cast("int"), F.col("words").cast("int")), " ")
    new = joined.withColumn("new", F.when(F.col("words") == F.col("size"), F.col("row.text")).otherwise(part))
    fields = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("new")}
    if "n_chars" in fields:
        fields["n_chars"] = F.length("new").cast(docs.schema["n_chars"].dataType)
    return new.select([column.alias(c) for c, column in fields.items()])


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    mixture = mix(table(spark, sf_dir, "documents"))
    took = mixture.taken.groupBy("key", "rep").agg(F.sum("length").alias("words"))
    sources = F.broadcast(mixture.sources.drop("source"))
    rows = mixture.rows.join(took, ["key", "rep"], "left").join(sources, "source_no")
    return rows.select(
        "doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken"), "source"
    )
