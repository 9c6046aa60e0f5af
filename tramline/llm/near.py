"""Near duplicates by ProbMinHash: sketches of weighted word shingles, bands, exact verification, classes.

Links inside a class are not listed. Texts of a bucket are compared with the bucket's leader, and only
what the classes so found leave apart is compared further, last by an exact prefix filter. So a bucket
of many copies costs as many comparisons as it has members, and no link between classes is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tramline.llm.common import deleted, staged, table, words
from tramline.llm.graph import components

SHINGLE = 5
# A pair of similarity 0.8 shares a band with probability 0.9999.
BANDS, ROWS = 24, 5
# 10 * overlap >= NEEDED * union: similarity of 0.8 or more.
NEEDED = 8
# Shingles sketched together.
CHUNK = 1 << 19
# Shingles a row of the prefix join carries to tell whether its pair has met before.
EARLIER = 32

GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(tokens: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in ascending order and their counts; a shorter text is one shingle."""
    import xxhash

    if not tokens:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    size = min(size, len(tokens))
    count = len(tokens) - size + 1
    joint = np.full(count, size, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            joint = _mixed(joint * GOLD + hashes[i : i + count])
    return np.unique(joint, return_counts=True)


def prob_min_hash(doc: np.ndarray, keys: np.ndarray, weights: np.ndarray, docs: int, registers: int) -> np.ndarray:
    """Sketches (docs x registers) of weighted sets given as parallel arrays of set number, element, weight.

    Each element sends arrivals of a Poisson process whose rate is its weight, each to a random
    register, which keeps its earliest element. An element stops once its next arrival is later than
    every register of its set. The share of equal registers estimates probability Jaccard.
    Arrivals of all elements advance together, one per round.
    """
    times = np.full(docs * registers, np.inf)
    kept = np.zeros(docs * registers, np.uint64)
    arrival = np.zeros(len(keys))
    step = 0
    while len(keys):
        step += 1
        with np.errstate(over="ignore"):
            draw = _mixed(keys + np.uint64(step) * GOLD)
        arrival = arrival - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)) / weights
        place = doc * registers + (_mixed(draw) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(times, place, arrival)
        first = times[place] == arrival
        kept[place[first]] = keys[first]
        open_ = np.unique(doc)
        latest = np.full(docs, -np.inf)
        latest[open_] = times.reshape(docs, registers)[open_].max(axis=1)
        on = arrival < latest[doc]
        doc, keys, weights, arrival = doc[on], keys[on], weights[on], arrival[on]
    return kept.reshape(docs, registers)


def _digest(tokens: list[bytes]) -> bytes:
    """Name of a sequence of words; ``word_mark`` is the same as a column."""
    return hashlib.md5(b" ".join(tokens), usedforsecurity=False).digest()


def word_mark(text: Column) -> Column:
    return F.unhex(F.md5(F.array_join(words(text), " ").cast("binary")))


def _sketcher(size: int, bands: int, rows: int):
    registers = bands * rows

    def band_hashes(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray | None]:
        some = [i for i, (keys, _) in enumerate(parts) if len(keys)]
        out: list[np.ndarray | None] = [None] * len(parts)
        if some:
            doc = np.repeat(np.arange(len(some)), [len(parts[i][0]) for i in some])
            keys = np.concatenate([parts[i][0] for i in some])
            weights = 1 + np.log(np.concatenate([parts[i][1] for i in some]))
            sketch = prob_min_hash(doc, keys, weights, len(some), registers).reshape(len(some), bands, rows)
            joint = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(some), bands))
            with np.errstate(over="ignore"):
                for r in range(rows):
                    joint = _mixed(joint * GOLD + sketch[:, :, r])
            for i, row in zip(some, joint.view(np.int64), strict=True):
                out[i] = row
        return out

    def sketch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids, marks, parts, total = [], [], [], 0
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                tokens = (text or "").encode("utf-8", "replace").split()
                ids.append(doc_id)
                marks.append(_digest(tokens))
                parts.append(shingles(tokens, size))
                total += len(parts[-1][0])
                if total >= CHUNK:
                    yield out(ids, marks, parts)
                    ids, marks, parts, total = [], [], [], 0
            if ids:
                yield out(ids, marks, parts)

    def out(ids, marks, parts):
        return pd.DataFrame(
            {
                "doc_id": ids,
                "node": marks,
                "bands": band_hashes(parts),
            }
        )

    return sketch


def _shingler(size: int):
    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            seen: dict[bytes, np.ndarray] = {}
            total = 0
            for text in frame["text"]:
                tokens = (text or "").encode("utf-8", "replace").split()
                mark = _digest(tokens)
                if mark not in seen:
                    seen[mark] = shingles(tokens, size)[0].view(np.int64)
                    total += len(seen[mark])
                if total >= CHUNK:
                    yield pd.DataFrame({"node": list(seen), "set": list(seen.values())})
                    seen, total = {}, 0
            yield pd.DataFrame({"node": list(seen), "set": list(seen.values())})

    return sets


def _verified(pairs: DataFrame, sets: DataFrame, needed: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets have the needed similarity."""
    left = sets.select(F.col("node").alias("a"), F.col("set").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("sb"))
    met = pairs.join(right, "b").join(left, "a")
    overlap = F.size(F.array_intersect("sa", "sb"))
    return met.filter(10 * overlap >= needed * (F.size("sa") + F.size("sb") - overlap)).select("a", "b")


def _rooted(table_: DataFrame, roots: DataFrame, name: str) -> DataFrame:
    """``table_`` with the root of its column ``name``; a node without links is its own root."""
    found = roots.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root"))
    return table_.join(found, name, "left").withColumn(f"{name}_root", F.coalesce(f"{name}_root", name))


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after ``links`` between their classes; only the classes are connected anew."""
    if links.isEmpty():
        return roots
    ends = _rooted(_rooted(links, roots, "a"), roots, "b").select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
    joined = staged(components(ends), "joined")
    new = joined.select(F.col("node").alias("root"), F.col("root").alias("new"))
    moved = roots.join(new, "root", "left").select("node", F.coalesce("new", "root").alias("root"))
    merged = staged(moved.unionByName(joined.join(roots, "node", "left_anti").select("node", "root")), "roots")
    deleted(joined, roots)
    return merged


def _prefix_pairs(nodes: DataFrame, sets: DataFrame, needed: int) -> DataFrame:
    """Pairs of ``nodes`` (node, root) of different roots that can be similar enough: an exact filter.

    Shingles are ranked from rare to frequent among these nodes. Similar sets share a shingle among the
    first of each, at places that leave enough of both for the overlap needed.
    """
    listed = nodes.join(sets, "node").select("node", "root", F.size("set").alias("n"), F.explode("set").alias("s"))
    listed = staged(listed, "contested")
    counts = listed.groupBy("s").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    order = W.partitionBy("node").orderBy(F.coalesce("df", F.lit(1)), "s")
    ranked = listed.join(counts, "s", "left").withColumn("i", F.row_number().over(order))
    # Overlap of at least needed/10 of n, so the place may be n - ceil(needed * n / 10) + 1 at most.
    first = ranked.filter(F.col("df").isNotNull() & (F.col("i") <= F.col("n") - F.ceil(F.col("n") * needed / 10) + 1))
    mixed = first.groupBy("s").agg(F.min("root").alias("r1"), F.max("root").alias("r2")).filter("r1 <> r2").select("s")
    first = first.join(mixed, "s", "left_semi")
    # A pair is wanted at its first common shingle alone; the list spares most repeats, and distinct() the rest.
    earlier = F.collect_list("s").over(W.partitionBy("node").orderBy("i").rowsBetween(W.unboundedPreceding, -1))
    columns = ("node", "root", "n", "i", "earlier")
    first = first.withColumn("earlier", F.slice(earlier, 1, EARLIER)).select("s", *columns)
    other = first.select("s", *[F.col(c).alias(f"{c}2") for c in columns])
    able = F.expr(
        f"node > node2 AND root <> root2 AND 10 * n >= {needed} * n2 AND 10 * n2 >= {needed} * n"
        f" AND (10 + {needed}) * (1 + least(n - i, n2 - i2)) >= {needed} * (n + n2)"
        " AND NOT arrays_overlap(earlier, earlier2)"
    )
    return first.join(other, ["s"]).filter(able).select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct()


def near_classes(
    docs: DataFrame, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, needed: int = NEEDED
) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, class_size, links, node, root.

    ``node`` names the text's sequence of words and ``root`` its class; ``class_id`` is the smallest doc_id of the class, and
    ``links`` is how many different texts of its class a text was found linked with. Texts with the
    same words are one node. Null and empty texts have no shingles; they are one node, alone. Texts
    of fewer words than a shingle are one shingle. Repeated rows and null ids stay; a class of null
    ids alone has a null class_id. Other columns are ignored. An empty table gives no rows.
    """
    # Ids travel as text: pandas would turn whole numbers beside nulls into floats.
    text = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketched = text.mapInPandas(_sketcher(size, bands, rows), "doc_id string, node binary, bands array<long>")
    sketched = staged(sketched.withColumn("doc_id", F.col("doc_id").cast("long")), "sketches")
    # Copies meet first: a bucket holds each text once, however many rows have it.
    spread = sketched.select("node", F.explode("bands").alias("bucket")).groupBy("bucket", "node").agg(F.lit(1).alias("x"))
    spread = spread.select("bucket", "node")
    shared = spread.groupBy("bucket").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least <> most")
    members = staged(spread.join(shared.select("bucket"), "bucket", "left_semi"), "members")
    owners = sketched.join(members.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    needed_rows = owners.select(F.col("doc_id").cast("string").alias("doc_id")).distinct()
    chosen = text.join(needed_rows, text["doc_id"].eqNullSafe(needed_rows["doc_id"]), "left_semi")
    sets = chosen.mapInPandas(_shingler(size), "node binary, set array<long>").dropDuplicates(["node"])
    sets = staged(sets.join(members.select("node").distinct(), "node", "left_semi"), "sets")

    # First each text with the leader it shares most buckets with, then what other leaders can add, then
    # what buckets still hold of different classes.
    leaders = members.groupBy("bucket").agg(F.min("node").alias("a"))
    met = members.join(leaders, "bucket").select("a", F.col("node").alias("b")).filter("a <> b")
    met = staged(met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("k")), "leaders")
    best = met.groupBy("b").agg(F.max(F.struct("k", "a")).alias("l")).select(F.col("l.a").alias("a"), "b")
    links = staged(_verified(best, sets, needed), "links")
    roots = staged(components(links), "roots")

    apart = _rooted(_rooted(met, roots, "a"), roots, "b").filter("a_root <> b_root").select("a", "b")
    found = staged(_verified(apart, sets, needed), "links")
    links, roots = links.unionByName(found), _merged(roots, found)

    rooted = _rooted(members, roots, "node")
    split = rooted.groupBy("bucket").agg(F.min("node_root").alias("r1"), F.max("node_root").alias("r2")).filter("r1 <> r2")
    contested = rooted.join(split, "bucket", "left_semi").select("node", F.col("node_root").alias("root")).distinct()
    found = staged(_verified(_prefix_pairs(contested, sets, needed), sets, needed), "links")
    deleted(members, sets, met)
    links, roots = links.unionByName(found), _merged(roots, found)

    degree = links.distinct().select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    rooted = _rooted(sketched.select("doc_id", "node"), roots, "node").withColumnRenamed("node_root", "root")
    classes = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return (
        rooted.join(classes, "root")
        .join(degree, "node", "left")
        .select("doc_id", "class_id", "class_size", F.coalesce("links", F.lit(0)).cast("long").alias("links"), F.hex("node").alias("node"), F.hex("root").alias("root"))
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of each class of ``docs``, with all its columns: that with the smallest id, a null id last.

    Rows that repeat both id and words are one.
    """
    classes = near_classes(docs, **options)
    first = classes.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "node")).alias("f"))
    kept = first.select(_row_key(F.col("f.doc_id"), F.col("f.node")).alias("__key"))
    # Texts go by id and words to the row that stays.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    met = docs.select(row, _row_key(F.col("doc_id"), F.hex(word_mark(docs["text"]))).alias("__key")).join(kept, "__key")
    order = W.partitionBy("__key").orderBy(F.lit(1))
    return met.withColumn("__n", F.row_number().over(order)).filter("__n = 1").select("__row.*")


def _row_key(doc_id: Column, mark: Column) -> Column:
    return F.concat_ws(":", mark, doc_id.cast("string"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents")).drop("node", "root")
