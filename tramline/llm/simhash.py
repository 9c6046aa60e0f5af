"""Near duplicates by SimHash: 64-bit fingerprints, shards of Burkhard-Keller trees, components.

Two fingerprints that differ in ``radius`` bits or fewer agree on one of radius + 1 blocks of bits, so
each goes to the shards of its block values and is looked up there alone. A shard holds a tree per block
value. A tree of all fingerprints, broadcast to all executors, would have to pass through the driver and
grow with the input; here a shard's trees travel by key to the tasks that ask them. A block value with
more fingerprints than one tree may hold is cut into several trees, and each is asked by every part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import staged, table
from tramline.llm.graph import components

SHINGLE = 3
SEED = 42
RADIUS = 2
BITS = 64
# Fingerprints in a tree at most, and in a shard on average.
PART = 1 << 16
# Fingerprints that go down the trees together, and shingles whose bits are counted together.
TOGETHER = 2048
CHUNK = 1 << 16


def fingerprint(tokens: list[bytes], size: int = SHINGLE, seed: int = SEED) -> int:
    """The bits set in more than half of the shingles' hashes; fewer words than a shingle are one shingle."""
    import xxhash

    if not tokens:
        return 0
    if len(tokens) <= size:
        return xxhash.xxh64_intdigest(b" ".join(tokens), seed)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    total = len(tokens) - size + 1
    runs = zip(*(tokens[i:] for i in range(size)))  # as many as the shortest has
    counts = np.zeros(BITS, np.int64)
    for start in range(0, total, CHUNK):
        n = min(CHUNK, total - start)
        hashes = np.fromiter((digest(join(next(runs)), seed) for _ in range(n)), "<u8", n)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def _printer(size: int, seed: int):
    def prints(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            # Of bytes, lower() changes A to Z alone, and split() cuts at the six blanks alone.
            found = [fingerprint((t or "").encode("utf-8", "replace").lower().split(), size, seed) for t in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"], "fp": np.array(found, np.uint64).view(np.int64)})

    return prints


def grow(items: np.ndarray, tree: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trees over distinct ``items``, one per number in ``tree``: edges, their children, roots by tree number.

    The children of a node are keyed by their distance to it: an edge is node * 65 + distance, in
    ascending order. All items walk down together; the first to take an edge becomes the node there.
    """
    _, roots = np.unique(tree, return_index=True)
    at = roots[tree]
    walking = np.flatnonzero(at != np.arange(len(items)))
    edges, children = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while len(walking):
        apart = np.bitwise_count(items[walking] ^ items[at[walking]])
        taken, first, which = np.unique(at[walking] * (BITS + 1) + apart, return_index=True, return_inverse=True)
        edges.append(taken)
        children.append(walking[first])
        at[walking] = walking[first][which]
        walking = walking[at[walking] != walking]
    edges, children = np.concatenate(edges), np.concatenate(children)
    order = np.argsort(edges)
    return edges[order], children[order], roots


def lookups(
    items: np.ndarray, trees: tuple, asked: np.ndarray, tree: np.ndarray, radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers (asked, item) of all pairs within ``radius``, each asked in its own tree, in batches.

    From a node at distance d only edges of d - radius to d + radius are followed.
    """
    edges, children, roots = trees
    for start in range(0, len(asked), TOGETHER):
        who = np.arange(start, min(start + TOGETHER, len(asked)))
        node = roots[tree[who]]
        while len(who):
            apart = np.bitwise_count(asked[who] ^ items[node]).astype(np.int64)
            near = apart <= radius
            yield who[near], node[near]
            low = np.searchsorted(edges, node * (BITS + 1) + np.maximum(apart - radius, 0))
            high = np.searchsorted(edges, node * (BITS + 1) + np.minimum(apart + radius, BITS), "right")
            count = high - low
            before = np.cumsum(count) - count
            who = np.repeat(who, count)
            node = children[np.arange(len(who)) + np.repeat(low - before, count)]


def merged(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``labels`` (each at or above its class's smallest member) after linking a with b."""
    while True:
        one, two = labels[a], labels[b]
        differ = one != two
        if not differ.any():
            return labels
        a, b, one, two = a[differ], b[differ], one[differ], two[differ]
        np.minimum.at(labels, np.maximum(one, two), np.minimum(one, two))
        while True:
            nearer = labels[labels]
            if np.array_equal(nearer, labels):
                break
            labels = nearer


def _linker(radius: int):
    def links(group: pd.DataFrame) -> pd.DataFrame:
        """Of a shard: each fingerprint that links to another, with the smallest of its class here."""
        group = group.sort_values(["bucket", "fp"], ignore_index=True)
        prints = group["fp"].to_numpy().view(np.uint64)
        part, low, high = (group[c].to_numpy() for c in ("part", "low", "high"))
        _, tree = np.unique(group["bucket"].to_numpy(), return_inverse=True)
        names, number = np.unique(prints, return_inverse=True)
        labels = np.arange(len(names))
        here, asking = part == low, part == high
        items, asked = prints[here], prints[asking]
        if len(items):
            own, others = number[here], number[asking]
            for who, node in lookups(items, grow(items, tree[here]), asked, tree[asking], radius):
                labels = merged(labels, others[who], own[node])
        moved = np.flatnonzero(labels != np.arange(len(names)))
        signed = names.view(np.int64)
        return pd.DataFrame({"a": signed[labels[moved]], "b": signed[moved]})

    return links


def blocks(print_: Column, radius: int = RADIUS) -> list[Column]:
    """One number per block of bits, different for different blocks."""
    out, start = [], 0
    for i in range(radius + 1):
        width = (BITS - start) // (radius + 1 - i)
        value = F.shiftrightunsigned(print_, start).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        out.append(value * (radius + 1) + i)
        start += width
    return out


def near_links(prints: DataFrame, radius: int = RADIUS, part: int = PART) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of distinct ``prints`` (fp) within ``radius`` bits.

    A shard gives a link per member of a class at most, not all its pairs. ``radius`` is at most 15.
    """
    if not 1 <= radius <= 15:
        raise ValueError("the radius must be between 1 and 15")
    shards = max(1, -(-prints.count() * (radius + 1) // part))
    routed = prints.select("fp", F.explode(F.array(*blocks(F.col("fp"), radius))).alias("bucket"))
    large = routed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > part)
    parts = F.ceil(F.coalesce("n", F.lit(1)) / part).cast("int")
    routed = routed.join(large, "bucket", "left").withColumn("parts", parts)
    routed = routed.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    # Part i of a large bucket meets every part j in the group of both; the lower is the tree there.
    routed = routed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    shard = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("bucket"), F.lit(shards))).otherwise(-1 - F.col("bucket"))
    routed = routed.select(
        shard.alias("shard"), "bucket", "fp", "part", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high")
    )
    return routed.groupBy("shard", "low", "high").applyInPandas(_linker(radius), "a long, b long")


def print_classes(
    docs: DataFrame, size: int = SHINGLE, seed: int = SEED, radius: int = RADIUS, part: int = PART
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    A fingerprint has the bits set in over half of the hashes of the text's shingles, repeats included.
    Those that differ in ``radius`` bits or fewer are linked, and component_id is the smallest doc_id
    that links reach. Null texts and texts without a word have fingerprint zero, linked like any other;
    fewer words than a shingle are one. Repeated rows and null ids stay; a component of null ids alone
    has a null id. Other columns are ignored. An empty table gives no rows.
    """
    # Ids travel as text: pandas would turn whole numbers beside nulls into floats.
    text = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketched = text.mapInPandas(_printer(size, seed), "doc_id string, fp long")
    sketched = staged(sketched.withColumn("doc_id", F.col("doc_id").cast("long")), "prints")
    # Copies meet first: from here on a fingerprint is one row, however many texts have it.
    distinct = staged(sketched.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(staged(near_links(distinct.select("fp"), radius, part), "links"))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return sketched.join(named, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return print_classes(table(spark, sf_dir, "documents"))
