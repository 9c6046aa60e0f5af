"""Long repeated byte strings by run-length compressed Burrows-Wheeler indexes.

Every string of LENGTH bytes has an anchor: the k-gram in it with the smallest hash, the same wherever
the string occurs. Neighbouring strings with one anchor form a piece of text. Only pieces whose anchor
another text has as well can hold a repeat; they are cut out and grouped by anchor, so that all occurrences of a
string meet in one group, whose distinct pieces are indexed together; an anchor with more than ANCHOR_BYTES of
them is not indexed, its strings meet one by one in a join. The index keeps the runs of the
transform, the text places at their ends, and for each interval of suffixes that agree on LENGTH bytes the first
document. Pieces stream through it from right to left by the last-to-first step over runs; the interval a
place falls into tells whether an earlier document has its string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import deleted, staged, table, text_or_empty, texts_at_once
from tramline.llm.exact import heavy_digests
from tramline.llm.near import GOLD, _mixed

LENGTH = 50
# Shorter grams are fewer, but many texts share some by chance.
GRAM = 24
# Bytes of distinct pieces indexed together, about.
INDEX_BYTES = 1 << 20
# One text in so many is looked at to find anchors that very many texts have. They only travel another way.
SAMPLE = 64
HOT = 512
# Bytes of distinct pieces of one anchor that are still indexed; the strings of others meet one by one.
ANCHOR_BYTES = 16 * INDEX_BYTES
# Bytes of text hashed in one go, few enough for a processor's cache.
HASHED_BYTES = 1 << 16
# Texts handed to Python at once, and pieces given back.
TEXTS, MOST_PIECES = 500, 1 << 15
# Bytes of text whose anchors make a cell, one in 14; anchors that a task holds before it gives them away.
CELL_BYTES, MOST_HELD = 1 << 23, 1 << 20
# Parts of the anchors indexed one after the other; their pieces are never all on disk twice.
PARTS = 2
# Sorted keys compared at once.
COMPARED = 1 << 20
SEPARATOR = 0xFF  # in no UTF-8 text
# So many strings or fewer go back through the index one by one, more of them side by side.
FEW = 8

LAST = (1 << 63) - 1


def _pairs_mixed() -> np.ndarray:
    """Hashes of all strings of two bytes, by their number."""
    number = np.arange(1 << 16, dtype=np.uint64)
    with np.errstate(over="ignore"):
        return _mixed(((number >> np.uint64(8)) + np.uint64(1)) * GOLD + (number & np.uint64(0xFF)) + np.uint64(1))


PAIRS = _pairs_mixed()


def _least(raw: bytes) -> np.ndarray:
    """For each place with LENGTH bytes after it: the smallest hash of the k-grams in them."""
    h, size, factor = PAIRS[np.ndarray(len(raw) - 1, ">u2", raw, strides=(1,))], 2, int(GOLD)
    while size < GRAM:
        step = min(size, GRAM - size)  # the last two halves may overlap
        # Sums of hashes times powers, which wrap; the powers tell the order of the letters.
        both = h[:-step] * np.uint64(factor)
        both += h[step:]
        h, size, factor = both, size + step, factor * factor % (1 << 64)
    span, least = LENGTH - GRAM + 1, _mixed(h)
    size = 1
    while 2 * size <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < span:
        least = np.minimum(least[: len(least) - (span - size)], least[span - size :])
    return least


def pieces_of(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, start and length of the pieces of texts, and whose each is. Piece i holds the strings that have its anchor."""
    lengths = np.fromiter(map(len, raws), np.int64, len(raws))
    counts = np.maximum(lengths - LENGTH + 1, 0)
    total = int(counts.sum())
    if not total:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    # All texts are hashed in one go; strings that begin in one text and end in another are left out.
    before = np.cumsum(counts) - counts
    of = np.repeat(np.arange(len(raws)), counts)
    least = _least(b"".join(raws))
    if len(raws) > 1:
        least = least[np.arange(total) + (np.cumsum(lengths) - lengths - before)[of]]
    new = np.empty(total, bool)
    np.not_equal(least[1:], least[:-1], out=new[1:])
    new[before[counts > 0]] = True
    first = np.flatnonzero(new)
    ends = np.append(first[1:], total)
    of = of[first]
    return least[first].view(np.int64), first - before[of], ends - first + LENGTH - 1, of


def pieces(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, start and length of the pieces of a text."""
    return pieces_of([raw])[:3]


@dataclass(frozen=True)
class RunIndex:
    """Runs of the transform of strings joined by separators, and first documents by interval."""

    starts: np.ndarray  # first row of each run
    heads: np.ndarray  # its letter
    targets: np.ndarray  # row that the first row of the run maps to
    ends: np.ndarray  # text place at the last row of the run
    intervals: np.ndarray  # first row of each interval of suffixes equal in LENGTH bytes
    firsts: np.ndarray  # smallest document in it
    run: np.ndarray  # run of each row
    interval: np.ndarray  # interval of each row

    def back(self, rows: np.ndarray) -> np.ndarray:
        """Rows of the suffixes one place further left."""
        run = self.run[rows]
        return self.targets[run] + rows - self.starts[run]

    def first(self, rows: np.ndarray) -> np.ndarray:
        return self.firsts[self.interval[rows]]


def _ordered(keys: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the ``keys``, which have ``width`` bits, in ascending order, and which differ from the one before."""
    bits = len(keys).bit_length()
    if width + bits <= 64:  # places travel in the low bits, so whole numbers are sorted
        both = np.sort((keys << np.uint64(bits)) | np.arange(len(keys), dtype=np.uint64))
        order, keys = (both & np.uint64((1 << bits) - 1)).view(np.int64), both >> np.uint64(bits)
        return order, np.concatenate([[True], keys[1:] != keys[:-1]])
    order = np.argsort(keys)
    new = np.ones(len(keys), bool)
    for i in range(0, len(keys) - 1, COMPARED):  # a large group's keys are not held twice
        own = keys[order[i : i + COMPARED + 1]]
        new[i + 1 : i + len(own)] = own[1:] != own[:-1]
    return order, new


def _dense(keys: np.ndarray, width: int) -> tuple[np.ndarray, int]:
    """Rank of each of the ``keys``, which have ``width`` bits, and how many ranks there are."""
    order, new = _ordered(keys, width)
    ranks = np.cumsum(new) - 1
    out = np.empty(len(keys), np.int64)
    out[order] = ranks
    return out, int(ranks[-1]) + 1


def _suffixes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in order, one more than the rank of each, and two facts of their first 32 letters: which differ from
    those of the suffix before, by order, and the rank by them, by place. By prefix doubling from eight letters on.

    A suffix's number is one more than those of smaller beginnings; only suffixes whose beginnings others have
    as well are sorted again.
    """
    count, size = len(text), 8
    padded = np.zeros(count + size - 1, np.uint8)
    padded[:count] = text + (text < SEPARATOR - 1)  # UTF-8 has no 0xFE; nought is what follows the text's end
    order, new = _ordered(np.ndarray(count, ">u8", padded, strides=(1,)).astype(np.uint64), 8 * size)
    short = np.uint32 if count < 1 << 31 else np.int64
    order = order.astype(short)
    del padded
    number = np.zeros(count + 1, short)  # the last stands for the end of the text
    bits = (count + 1).bit_length()
    starts = np.flatnonzero(new).astype(short)
    sizes = np.diff(starts, append=short(count))
    number[order] = np.repeat(starts + short(1), sizes)
    begun, half = new, None  # by order: where suffixes differ from the one before in as many letters
    several = np.repeat(sizes > 1, sizes)
    at, tied = np.flatnonzero(several).astype(short), order[several]
    while len(tied):
        if size == 32:
            half = begun.copy(), _by_place(begun, order)
        keys = number[tied].astype(np.uint64)
        keys <<= np.uint64(bits)
        keys |= number[np.minimum(tied + short(size), short(count))]
        by, new = _ordered(keys, 2 * bits)
        tied = tied[by]
        del keys, by
        order[at] = tied
        begun[at] |= new
        starts = np.flatnonzero(new).astype(short)
        sizes = np.diff(starts, append=short(len(tied)))
        # What was equal so far lies together, from its first one's place on.
        number[tied] = np.repeat(at[starts] + short(1), sizes)
        several = np.repeat(sizes > 1, sizes)
        at, tied = at[several], tied[several]
        size *= 2
    return order, number[:count], *(half or (begun, _by_place(begun, order)))


def _by_place(begun: np.ndarray, order: np.ndarray) -> np.ndarray:
    out = np.empty(len(order), np.int32 if len(order) < 1 << 31 else np.int64)
    out[order] = np.cumsum(begun) - 1
    return out


def _ranks(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of every suffix, and rank by its first 32 letters."""
    _, number, _, half = _suffixes(text)
    return number.astype(np.int64) - 1, half


def build(strings: list[bytes], docs: np.ndarray) -> tuple[RunIndex, np.ndarray]:
    """Index of ``strings``, each held by a document, and the row of each string's separator."""
    sep = bytes([SEPARATOR])
    text = np.frombuffer(sep.join(strings) + sep, np.uint8)
    lengths = np.fromiter(map(len, strings), np.int64, len(strings)) + 1
    order, number, begun, half = _suffixes(text)
    rows = number[np.cumsum(lengths) - 1].astype(np.int64) - 1
    del number
    # Of neighbours that agree in 32 letters, those that agree in as many further on, up to LENGTH.
    alike = np.flatnonzero(~begun[1:])
    half = np.append(half, np.zeros(LENGTH, half.dtype))
    later = half[order[alike] + (LENGTH - 32)]
    later = later != half[order[alike + 1] + (LENGTH - 32)]
    begun[1:][alike[later]] = True
    del half, alike, later
    intervals = np.flatnonzero(begun)
    interval = np.cumsum(begun, dtype=np.int32)
    interval -= 1
    held, holder = np.unique(docs, return_inverse=True)  # numbers of half the size stand for the documents
    owner = np.repeat(holder.astype(np.int32), lengths)[order]
    firsts = held[np.minimum.reduceat(owner, intervals)]
    del owner, begun
    letters = np.roll(text, 1)[order]
    short = np.int32 if len(text) < 1 << 31 else np.int64
    starts = np.flatnonzero(np.concatenate([[True], letters[1:] != letters[:-1]])).astype(short)
    heads, sizes = letters[starts], np.diff(starts, append=short(len(text)))
    # Rows that begin with a letter lie together, in the order of the rows that the letter precedes.
    by_letter = np.argsort(heads, kind="stable")
    targets = np.empty(len(starts), short)
    targets[by_letter] = np.cumsum(sizes[by_letter], dtype=short) - sizes[by_letter]
    del letters, by_letter
    run = np.repeat(np.arange(len(starts), dtype=np.int32), sizes)
    return RunIndex(starts, heads, targets, order[starts + sizes - 1], intervals, firsts, run, interval), rows


def _holders(strings: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place with LENGTH bytes after it: the smallest document with these bytes; and the places of each string."""
    index, rows = build(strings, docs)
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    sizes = np.maximum(lengths - LENGTH + 1, 0)
    out = np.empty(int(sizes.sum()), np.int64)
    # Longest first, so that the strings not yet at their start are always the first ones.
    longest = np.argsort(-lengths, kind="stable")
    # Place 0 of the next string is where the last of this one would end.
    last, rows = (np.cumsum(sizes) + LENGTH - 1)[longest], rows[longest]
    steps = np.arange(1, int(lengths.max(initial=0)) + 1)
    on = len(strings) - np.searchsorted(np.sort(lengths), steps)
    for step, count in zip(steps.tolist(), on.tolist(), strict=True):
        if count <= FEW:
            break
        rows = index.back(rows[:count])
        if step >= LENGTH:
            out[last[:count] - step] = index.first(rows)
    else:
        return out, sizes
    # A few long strings are left, which go on one by one; the step is that of RunIndex.back.
    run, shift = memoryview(index.run), memoryview(index.targets - index.starts)
    for i, row in enumerate(rows[:count].tolist()):
        passed = []
        for _ in range(step, int(lengths[longest[i]]) + 1):
            row += shift[run[row]]
            passed.append(row)
        passed = index.first(np.array(passed[max(LENGTH - step, 0) :], np.int64))
        end = last[i] - max(step, LENGTH) + 1
        out[end - len(passed) : end] = passed[::-1]
    return out, sizes


def first_holders(strings: list[bytes], docs: np.ndarray) -> list[np.ndarray]:
    """For each string and each place with LENGTH bytes after it: the smallest document with these bytes."""
    out, sizes = _holders(strings, docs)
    return np.split(out, np.cumsum(sizes)[:-1])


def _encoded(texts: Iterable[str]) -> Iterator[list[bytes]]:
    """The bytes of texts, about HASHED_BYTES of them at a time."""
    raws, size = [], 0
    for text in texts:
        raws.append(text.encode("utf-8", "replace"))
        size += len(raws[-1])
        if size > HASHED_BYTES:
            yield raws
            raws, size = [], 0
    if raws:
        yield raws


def _named(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Anchors of texts and the names of these."""
    for frame in frames:
        names, at = frame["name"].to_numpy(), 0
        for raws in _encoded(frame["text"]):
            anchors, _, _, of = pieces_of(raws)
            yield anchors, names[at + of]
            at += len(raws)


def _anchors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for anchors, names in _named(frames):
        yield pd.DataFrame({"anchor": anchors, "name": names}).drop_duplicates()


def _in(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which of the values occur among others."""
    if not len(ascending):
        return np.zeros(len(values), bool)
    return ascending[np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)] == values


def _cells(keys: np.ndarray, count: int) -> np.ndarray:
    return (_mixed(keys.view(np.uint64)) % np.uint64(count)).astype(np.int64)


def _packed(cell: np.ndarray, anchors: np.ndarray, names: np.ndarray) -> pd.DataFrame:
    """A row per cell with its anchors and names, eight bytes each."""
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]) if len(cell) else [])
    cuts = np.append(first, len(cell)).tolist()
    own, of = anchors[order], names[order]
    both = [(own[a:b].tobytes(), of[a:b].tobytes()) for a, b in pairwise(cuts)]
    return pd.DataFrame({"cell": cell[first], "anchors": [x for x, _ in both], "names": [y for _, y in both]})


def _unpacked(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.frombuffer(b"".join(group[c]), np.int64) for c in ("anchors", "names"))


def _dealt(cells: int, hot: np.ndarray):
    """Anchors and names by cells of the anchors; the hot ones stay away, as they need no company."""
    most = min(MOST_HELD, cells << 14)

    def dealt(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for anchors, names in _named(frames):
            cold = ~_in(anchors, hot)
            held.append((anchors[cold], names[cold]))
            size += len(held[-1][0])
            if size > most:
                yield _packed(_cells(whole := np.concatenate([a for a, _ in held]), cells), whole, np.concatenate([n for _, n in held]))
                held, size = [], 0
        if size:
            yield _packed(_cells(whole := np.concatenate([a for a, _ in held]), cells), whole, np.concatenate([n for _, n in held]))

    return dealt


def _met(cells: int):
    """Of the anchors of a cell those that several names have, by cells of the names."""

    def met(group: pd.DataFrame) -> pd.DataFrame:
        anchors, names = _unpacked(group)
        order = np.argsort(anchors)
        anchors, names = anchors[order], names[order]
        first = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
        company = np.minimum.reduceat(names, first) != np.maximum.reduceat(names, first)
        company = np.repeat(company, np.diff(np.append(first, len(anchors))))
        anchors, names = anchors[company], names[company]
        return _packed(_cells(names, cells), anchors, names)

    return met


def _by_name(group: pd.DataFrame) -> pd.DataFrame:
    """A row per name with its anchors."""
    anchors, names = _unpacked(group)
    order = np.argsort(names, kind="stable")
    anchors, names = anchors[order], names[order]
    first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
    return pd.DataFrame({"name": names[first], "shared": np.split(anchors, first[1:])})


def _cut(hot: np.ndarray):
    """Pieces of texts whose anchors are hot or shared, with their marks."""
    columns = ["row", "doc", "start", "anchor"]

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        held, numbers = [], []

        def out() -> pd.DataFrame:
            marks = np.fromiter(map(xxhash.xxh3_64_intdigest, held), np.uint64, len(held)) ^ np.uint64(1 << 63)
            found = dict(zip(columns, map(np.concatenate, zip(*numbers, strict=True)), strict=True))
            return pd.DataFrame(found | {"mark": marks.view(np.int64), "piece": held})

        for frame in frames:
            rows, docs, shared, at = frame["row"].to_numpy(), frame["doc"].to_numpy(), frame["shared"].tolist(), 0
            for raws in _encoded(frame["text"]):
                own = [np.zeros(0, np.int64) if x is None else np.asarray(x, np.int64) for x in shared[at : at + len(raws)]]
                anchors, starts, lengths, of = pieces_of(raws)
                # An anchor counts for the texts it is shared for; one cut in vain would only be one too many.
                salt = np.arange(len(raws)).astype(np.uint64) * GOLD
                wanted = np.concatenate(own).view(np.uint64) ^ np.repeat(salt, [len(x) for x in own])
                wanted = _in(anchors.view(np.uint64) ^ salt[of], np.sort(wanted)) | _in(anchors, hot)
                anchors, starts, lengths, of = anchors[wanted], starts[wanted], lengths[wanted], of[wanted]
                held += [raws[i][a:b] for i, a, b in zip(of.tolist(), starts.tolist(), (starts + lengths).tolist(), strict=True)]
                numbers.append((rows[at + of], docs[at + of], starts, anchors))
                at += len(raws)
                if len(held) > MOST_PIECES:
                    yield out()
                    held, numbers = [], []
        if held:
            yield out()

    return cut


def _indexed(group: pd.DataFrame) -> pd.DataFrame:
    """Spans of equal first document in the pieces of a group; places count from the piece's start."""
    group = group.sort_values(["anchor", "mark"], ignore_index=True)
    first, sizes = _holders(group["piece"].tolist(), group["low"].to_numpy())
    begins, of = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
    cuts = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (of[1:] != of[:-1])]))
    of, ends = of[cuts], np.append(cuts[1:], len(first))
    low, high = group["low"].to_numpy(), group["high"].to_numpy()
    # Of a piece that one document has alone, only what others have as well.
    keep = (low != high)[of] | (np.bincount(of, minlength=len(sizes))[of] > 1) | (first[cuts] != low[of])
    cuts, ends, of = cuts[keep], ends[keep], of[keep]
    return pd.DataFrame(
        {
            "anchor": group["anchor"].to_numpy()[of],
            "mark": group["mark"].to_numpy()[of],
            "from": cuts - begins[of],
            "to": ends - begins[of] - 1 + LENGTH,
            "first": first[cuts],
        }
    )


def _strings(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for anchor, mark, low, piece in zip(frame["anchor"], frame["mark"], frame["low"], frame["piece"], strict=True):
            out += [(anchor, mark, low, i, bytes(piece[i : i + LENGTH])) for i in range(len(piece) - LENGTH + 1)]
            if len(out) > 100_000:
                yield pd.DataFrame(out, columns=["anchor", "mark", "low", "from", "string"])
                out = []
        if out:
            yield pd.DataFrame(out, columns=["anchor", "mark", "low", "from", "string"])


def _by_string(distinct: DataFrame) -> DataFrame:
    """The spans that ``_indexed`` finds, by a join on the strings themselves; no task holds an anchor's pieces."""
    strings = distinct.select("anchor", "mark", "low", "piece").mapInPandas(_strings, "anchor long, mark long, low long, from long, string binary")
    strings = staged(strings, "strings")
    first = strings.groupBy("string").agg(F.min("low").alias("first"))  # combined map-side, however many hold it
    met = strings.drop("low").join(first, "string")
    return met.select("anchor", "mark", "from", (F.col("from") + LENGTH).alias("to"), "first")


def _ranges(cuts: DataFrame, anchor_bytes: int) -> DataFrame:
    """Staged rows and spans of theirs that an earlier document has; ``cuts`` has all pieces of an anchor or none."""
    distinct = cuts.groupBy("anchor", "mark").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.first("piece").alias("piece"))
    distinct = staged(distinct.withColumn("size", F.octet_length("piece")), "pieces")
    sizes = distinct.groupBy("anchor").agg(F.sum("size").alias("size"))
    large = staged(sizes.filter(F.col("size") > anchor_bytes).select("anchor"), "large")
    size = distinct.agg(F.sum("size")).first()[0] or 0
    distinct = distinct.drop("size")
    groups = max(1, -(-size // INDEX_BYTES))
    small = distinct.join(large, "anchor", "left_anti")
    # The anchors of a part agree in their last bits, so groups go by a hash.
    spans = small.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(groups)).alias("group"))
    spans = spans.applyInPandas(_indexed, "anchor long, mark long, from long, to long, first long")
    spans = staged(spans.unionByName(_by_string(distinct.join(large, "anchor", "left_semi"))), "spans")
    deleted(distinct, large)
    met = cuts.select("row", "doc", "start", "anchor", "mark").join(spans, ["anchor", "mark"]).filter("first < doc")
    # Both ends in one number; a text has less than 2^31 bytes.
    span = F.shiftleft(F.col("start") + F.col("from"), 32).bitwiseOR(F.col("start") + F.col("to"))
    ranges = staged(met.select("row", span.alias("span")), "ranges")
    deleted(spans)
    return ranges


def _removed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for row, text, spans in zip(frame["row"], frame["text"], frame["spans"], strict=True):
            raw = text.encode("utf-8", "replace")
            spans = np.asarray(spans, np.int64)
            begun, ended = (np.bincount(x, minlength=len(raw) + 1) for x in (spans >> 32, spans & 0xFFFFFFFF))
            gone = np.cumsum((begun - ended)[:-1]) > 0
            kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            edges = int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
            out.append((row, int(gone.sum()), edges, hashlib.sha256(kept).hexdigest(), kept))
        yield pd.DataFrame(out, columns=["row", "n_removed", "n_spans", "kept_sha256", "kept"])


def without_long_repeats(docs: DataFrame, with_bytes: bool = False, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, on demand kept.

    A byte goes if a string of LENGTH bytes that covers it also starts in a document of smaller doc_id,
    judged on the texts as given. A null doc_id is larger than any other; rows with one doc_id do not
    remove from each other. Null and empty texts have no bytes; texts shorter than LENGTH stay whole.
    Other columns are ignored. An empty table gives no rows.
    """
    text = text_or_empty(docs["text"])
    texts = docs.select(
        F.xxhash64("doc_id", text).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        F.unhex(F.md5(text.cast("binary"))).alias("digest"),
    )
    facts = texts.select(
        "row", "doc", "doc_id", "digest", F.octet_length("text").cast("long").alias("length"), F.sha2(F.col("text").cast("binary"), 256).alias("sha")
    )
    facts = staged(facts, "facts")
    # Copies of a text that very many rows have are settled at once; only the first goes on.
    heavy = staged(heavy_digests(facts.select("digest", "length", F.col("doc").alias("doc_id"))), "heavy")
    heavy = F.broadcast(heavy.select("digest", F.col("heavy_rank.d").alias("owner")))  # at most exact.HEAVY rows
    first = texts.join(heavy, "digest", "left").filter(F.col("owner").isNull() | (F.col("owner") == F.col("doc")))
    # Anchors go by document, whose small numbers compress well; rows without one go by their hash.
    first = first.select("row", "doc", F.when(F.col("doc") < LAST, F.col("doc")).otherwise(F.col("row")).alias("name"), "text")

    sample = first.filter(F.pmod("row", F.lit(SAMPLE)) == 0).select("name", "text").mapInPandas(_anchors, "anchor long, name long")
    hot = sample.agg(F.expr(f"approx_top_k(anchor, {HOT}, {8 * HOT})").alias("top")).select(F.explode("top").alias("t"))
    # Seen in several sampled texts, so surely shared: their rows need no company.
    hot = staged(hot.filter("t.count >= 16").select(F.col("t.item").alias("anchor")), "hot")
    known = np.sort(np.array([r["anchor"] for r in hot.collect()], np.int64))  # at most HOT numbers
    # The others meet by cells, which travel as arrays: to Spark a row is what a task has of a cell, not an anchor.
    size = facts.agg(F.sum("length")).first()[0] or 0
    cells = max(1, -(-size // CELL_BYTES))
    packed = "cell long, anchors binary, names binary"
    shared = first.select("name", "text").mapInPandas(_dealt(cells, known), packed)
    shared = shared.groupBy("cell").applyInPandas(_met(cells), packed)
    shared = shared.groupBy("cell").applyInPandas(_by_name, "name long, shared array<long>")
    # Written by itself, so that the anchors' shuffle is gone when the texts travel.
    with texts_at_once(docs.sparkSession, TEXTS):
        shared = staged(shared, "shared")
    cuts = first.join(shared, "name", "left" if len(known) else "inner").select("row", "doc", "text", "shared")
    cuts = cuts.mapInPandas(_cut(known), "row long, doc long, start long, anchor long, mark long, piece binary")
    with texts_at_once(docs.sparkSession, TEXTS):
        cuts = staged(cuts, "cuts")
    deleted(shared)
    # One part of the anchors after the other, so that the pieces of a part alone lie beside their shuffle.
    parts = [_ranges(cuts.filter(F.pmod("anchor", F.lit(PARTS)) == i), anchor_bytes) for i in range(PARTS)]
    ranges = parts[0]
    for part in parts[1:]:
        ranges = ranges.unionByName(part)
    ranges = staged(ranges.groupBy("row").agg(F.collect_set("span").alias("spans")), "ranges")
    deleted(cuts, hot, *parts)
    judged = first.dropDuplicates(["row"]).select("row", "text").join(ranges, "row")
    judged = judged.mapInPandas(_removed, "row long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    if not with_bytes:
        judged = judged.drop("kept")

    copies = (F.col("owner") < F.col("doc")) & (F.col("length") >= LENGTH)
    empty = hashlib.sha256(b"").hexdigest()
    if with_bytes:
        facts = facts.join(texts.select("row", F.col("text").cast("binary").alias("whole")).dropDuplicates(["row"]), "row")
    # A copy's own row is not among the judged; the first one's is.
    result = facts.join(heavy, "digest", "left").join(judged, "row", "left").withColumn("copy", F.coalesce(copies, F.lit(False)))
    zero = F.lit(0).cast("long")
    columns = [
        "doc_id",
        F.col("length").alias("n_bytes"),
        F.when(F.col("copy"), F.col("length")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(F.col("copy"), F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(F.col("copy"), empty).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
    ]
    if with_bytes:
        columns.append(F.when(F.col("copy"), F.lit(b"")).otherwise(F.coalesce("kept", "whole")).alias("kept"))
    return result.select(columns)


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_long_repeats(table(spark, sf_dir, "documents"))
