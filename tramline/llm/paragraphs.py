"""Repeated paragraphs by MinHash banding, exact verification and components.

A text is cut into paragraphs at line and sentence ends, so a passage has the same paragraphs wherever
it stands, also in the middle of a line. Paragraphs too short to tell a repeat from chance are never
removed. Equal paragraphs are one node, however often they occur. Nodes that share a band are compared
with the bucket's smallest node; then buckets that still hold several classes are compared
further through an exact prefix filter. Of each class of paragraphs the first occurrence stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import staged, table, text_or_empty
from tramline.llm.graph import components
from tramline.llm.near import _merged, _mixed, _prefix_pairs, _rooted, _verified

# Words of a paragraph that can be removed, at least.
LEAST_WORDS = 8
SHINGLE = 5
# A pair of similarity 0.8 shares one of 5 bands of 2 rows with probability 0.994; equal ones always do.
BANDS, ROWS = 5, 2
NEEDED = 8

# A line end, or the end of a sentence.
CUT = re.compile(rb"\n|(?<=[.!?])[ \t]+")
GOLD = np.uint64(0x9E3779B97F4A7C15)


def _parts(text: str | None, least: int) -> Iterator[tuple[int, list[bytes]]]:
    """Place and words of each paragraph of a text that has ``least`` words or more."""
    for place, part in enumerate(CUT.split((text or "").encode("utf-8", "replace"))):
        if len(part) >= 2 * least - 1 and len(words := part.split()) >= least:
            yield place, words


def _hashed(parts: list[list[bytes]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all parts in a row, and the part each belongs to. Parts have ``size`` words or more."""
    import xxhash

    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for p in parts for w in p), np.uint64, int(lengths.sum()))
    owner = np.repeat(np.arange(len(parts)), lengths)
    joint = np.full(max(len(hashes) - size + 1, 0), size, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            joint = _mixed(joint * GOLD + hashes[i : i + len(joint)])
    whole = owner[: len(joint)] == owner[size - 1 :]
    return joint[whole], owner[: len(joint)][whole]


def _node(words: list[bytes]) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63)


def _cut(least: int):
    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows, places, nodes, sizes = [], [], [], []
            for row, text in zip(frame["row"], frame["text"], strict=True):
                for place, words in _parts(text, least):
                    rows.append(row)
                    places.append(place)
                    nodes.append(_node(words))
                    sizes.append(len(words))
            columns = {"row": rows, "place": places, "node": nodes, "n_words": sizes}
            yield pd.DataFrame({name: np.array(values, np.int64) for name, values in columns.items()})

    return cut


def _distinct(frames: Iterator[pd.DataFrame], least: int) -> Iterator[dict[int, list[bytes]]]:
    """Paragraphs by node, each once per chunk."""
    seen: dict[int, list[bytes]] = {}
    size = 0
    for frame in frames:
        for text in frame["text"]:
            for _, words in _parts(text, least):
                if (node := _node(words)) not in seen:
                    seen[node] = words
                    size += len(words)
            if size > 500_000:
                yield seen
                seen, size = {}, 0
    if seen:
        yield seen


def _bander(least: int, size: int, bands: int, rows: int):
    def band(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for seen in _distinct(frames, least):
            shingles, owner = _hashed(list(seen.values()), size)
            first = np.flatnonzero(np.diff(owner, prepend=-1))  # every part has a shingle
            nodes = np.array(list(seen), np.int64)
            with np.errstate(over="ignore"):
                for b in range(bands):
                    joint = np.full(len(nodes), b + 1, np.uint64)
                    for r in range(rows):
                        salt = np.uint64(1 + b * rows + r) * GOLD
                        joint = _mixed(joint * GOLD + np.minimum.reduceat(_mixed(shingles + salt), first))
                    yield pd.DataFrame({"bucket": joint.view(np.int64), "node": nodes})

    return band


def _sets(least: int, size: int):
    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for seen in _distinct(frames, least):
            shingles, owner = _hashed(list(seen.values()), size)
            order = np.lexsort((shingles, owner))
            shingles, owner = shingles[order], owner[order]
            new = np.concatenate([[True], (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])])
            shingles, owner = shingles[new], owner[new]
            ends = np.flatnonzero(np.diff(owner, append=len(seen) + 1)) + 1
            yield pd.DataFrame({"node": np.array(list(seen), np.int64), "set": np.split(shingles.view(np.int64), ends[:-1])})

    return sets


def _named(docs: DataFrame) -> DataFrame:
    text = text_or_empty(docs["text"])
    return docs.select(F.xxhash64("doc_id", text).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def repeated_paragraphs(
    docs: DataFrame, least: int = LEAST_WORDS, size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, needed: int = NEEDED
) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` (row, doc_id), and the paragraphs to remove from them.

    A row is named by the hash of its id and text, so rows that repeat both share a name. The second table has row, place, n_words, first_id, class_id: place counts the paragraphs of the
    text from 0, class_id names the class, and first_id is the document of the occurrence that stays, the
    one with the smallest doc_id, a null id last, then row and place. Repeats inside one text count as
    well. Null and empty texts have no paragraphs. Rows that repeat id and text are one text, removed from
    alike. Other columns are ignored.
    """
    if least < size:
        raise ValueError("paragraphs need as many words as a shingle")
    names = _named(docs)
    ids = staged(names.select("row", "doc_id"), "ids")
    text = names.select("text")
    occurrences = staged(
        names.select("row", "text").mapInPandas(_cut(least), "row long, place long, node long, n_words long"), "places"
    )
    # Each chunk of a task names a node once, so a paragraph of very many texts is already few rows here;
    # dealt by bucket, they need no other shuffle up to the join.
    spread = text.mapInPandas(_bander(least, size, bands, rows), "bucket long, node long")
    spread = spread.repartition("bucket").dropDuplicates(["bucket", "node"])
    shared = spread.groupBy("bucket").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a <> z")
    members = staged(spread.join(shared.select("bucket", "a"), "bucket"), "members")
    nodes = staged(members.select("node").distinct(), "nodes")
    # One text that has the paragraph is read again for its shingles, not all of them.
    holders = occurrences.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("row").alias("row")).select("row").distinct()
    sets = names.join(holders, "row", "left_semi").select("text").mapInPandas(_sets(least, size), "node long, set array<long>")
    sets = staged(sets.join(nodes, "node", "left_semi").dropDuplicates(["node"]), "sets")

    pairs = members.filter("a <> node").select("a", F.col("node").alias("b")).distinct()
    found = staged(_verified(pairs, sets, needed), "links")
    roots = staged(components(found), "roots")
    rooted = _rooted(members.drop("a"), roots, "node")
    split = rooted.groupBy("bucket").agg(F.min("node_root").alias("r1"), F.max("node_root").alias("r2")).filter("r1 <> r2")
    contested = rooted.join(split, "bucket", "left_semi").select("node", F.col("node_root").alias("root")).distinct()
    roots = _merged(roots, staged(_verified(_prefix_pairs(contested, sets, needed), sets, needed), "links"))

    placed = _rooted(occurrences, roots, "node").withColumnRenamed("node_root", "root")
    placed = placed.join(ids.dropDuplicates(["row"]), "row")
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row", "place")
    first = placed.groupBy("root").agg(F.min(order).alias("f"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    removed = placed.join(first, "root").filter((F.col("row") != F.col("f.row")) | (F.col("place") != F.col("f.place")))
    found = removed.select("row", "place", "n_words", F.col("f.doc_id").alias("first_id"), F.col("root").alias("class_id"))
    return ids, found.distinct()


def _without(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        kept = []
        for text, places in zip(frame["text"], frame["places"], strict=True):
            drop = set() if places is None else set(places)
            raw, out, at = text.encode("utf-8", "replace"), [], 0
            for place, cut in enumerate([*(m.end() for m in CUT.finditer(raw)), len(raw)]):
                if place not in drop:
                    out.append(raw[at:cut])
                at = cut
            kept.append(b"".join(out).decode("utf-8", "replace"))
        yield frame[["doc_id"]].assign(text=kept)


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """doc_id and text of every row of ``docs`` without its repeated paragraphs."""
    names, (_, removed) = _named(docs), repeated_paragraphs(docs, **options)
    places = removed.groupBy("row").agg(F.collect_list("place").alias("places"))
    met = names.join(places, "row", "left").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "places")
    return met.mapInPandas(_without, "doc_id string, text string").withColumn("doc_id", F.col("doc_id").cast("long"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: what is removed from it, and the class it falls in by that.

    class_id is the smallest id among the documents whose paragraphs stay for it, or its own; it is no
    component. links is how many classes of paragraphs were removed, and linked names each: the document
    whose paragraph stays, the class of paragraphs and the words removed for it.
    """
    ids, removed = repeated_paragraphs(table(spark, sf_dir, "documents"))
    return linked_docs(ids, removed)


def linked_docs(ids: DataFrame, removed: DataFrame) -> DataFrame:
    """The rows of ``ids`` with what is removed from each, as ``repeated_paragraphs`` gives both."""
    links = removed.groupBy("row", "class_id", "first_id").agg(F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("words"))
    sums = links.groupBy("row").agg(
        F.sum("n").alias("n_removed"),
        F.sum("words").alias("removed_words"),
        F.count(F.lit(1)).alias("links"),
        F.min("first_id").alias("first_id"),
        F.sort_array(F.collect_list(F.struct("first_id", "class_id", "words"))).alias("linked"),
    )
    zero = F.lit(0).cast("long")
    return (
        ids.join(sums, "row", "left")
        .select(
            "doc_id",
            F.least("doc_id", "first_id").alias("class_id"),
            F.coalesce("links", zero).alias("links"),
            F.coalesce("n_removed", zero).alias("n_removed"),
            F.coalesce("removed_words", zero).alias("removed_words"),
            F.coalesce("linked", F.array().cast("array<struct<first_id:bigint,class_id:bigint,words:bigint>>")).alias("linked"),
        )
    )
