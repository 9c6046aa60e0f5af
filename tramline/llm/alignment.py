"""Alignment of two tokenizers: pointer jumping finds the groups, the corpus counts how ids are linked.

Every token points to the token that overlaps it and reaches farthest right; doubling the pointers leads
each to the last token of its component, which labels the group. Both tokenizers cover a text without
gaps, so components never cross documents and all documents of a batch jump together.

How many documents hold a pair of ids is a sum over the corpus. Documents are put into blocks. A block
names each of its pairs once, so what is shuffled are the pairs of blocks and not those of documents, and
the corpus counts come back to a block as one list.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import staged, table, texts_at_once

# Bytes of text tokenised together, and pairs of documents in a block; one text may hold more of either.
BATCH_BYTES = 1 << 18
BLOCK_PAIRS = 1 << 18
# Texts handed to Python at once.
TEXTS = 500
# Words, and letters of them, whose ids a worker remembers; it holds twice as many at most.
KNOWN_WORDS, KNOWN_LETTERS = 1 << 16, 1 << 21
# One block in so many is followed by a search for cycles among all objects.
SEARCHED = 4
# Groups with more links than this are counted by distinct ids instead of link by link.
WIDE = 4096


def default_a() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def default_b() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_alphabet() -> dict[str, int]:
    """Character of the byte-level alphabet to byte: printable Latin-1 stands for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Side:
    """A tokenizer's ids and the bytes that each stands for."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.bytes = tokens
        self.lengths = np.array([len(t) for t in tokens], np.int64)

    def spells(self, ids: list[int], raw: bytes) -> bool:
        return b"".join(map(self.bytes.__getitem__, ids)) == raw


# Anything but signs whose class (letter, number, blank, other) is the same in every Unicode version and library.
UNSURE = re.compile("[^\t\n\r -~\xa1-\xac\xae-\u024f]")


def words_of_sure_signs():
    """The byte-level pattern (endings after an apostrophe, letters, numbers, others, blanks) for sure signs alone."""
    sure = [c for c in map(chr, range(0x250)) if not UNSURE.match(c)]
    blank = "\t\n\r "

    def signs(kinds: str, but: str = "") -> str:
        return "".join(re.escape(c) for c in sure if c not in but and (unicodedata.category(c)[0] in kinds))

    letters, numbers, others = signs("L"), signs("N"), signs("MPSZC", blank)
    endings = "'(?:[stmd]|re|ve|ll)"
    return re.compile(
        f"{endings}| ?[{letters}]+| ?[{numbers}]+| ?[{others}]+|[{blank}]+(?![^{blank}])|[{blank}]+"
    ).findall


class Unspelled(Exception):
    """A word's ids do not give its bytes."""


class Known(dict):
    """Words and their ids; a word it lacks is taken over from the memory before, or merged."""

    def __init__(self, merged, before: dict[str, list[int]]) -> None:
        self.merged, self.before, self.letters = merged, before, 0

    def __missing__(self, word: str) -> list[int]:
        own = self.before.get(word)
        if own is None:
            own = self.merged(word)
        self[word] = own
        self.letters += len(word)
        return own


class ByteLevel(Side):
    """A byte-level BPE in JSON form.

    Its words are cut and merged one by one, and words repeat, so a worker remembers their ids. Texts with
    signs that libraries may class differently go whole through the tokenizer.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        alphabet = byte_alphabet()
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        super().__init__([bytes(alphabet[c] for c in n) if all(c in alphabet for c in n) else n.encode() for n in names])
        self.cut = self._cutter()
        self.letters = {b: c for c, b in alphabet.items()}
        self.known = Known(self._merged, {})

    def _cutter(self):
        """The function that cuts a text of sure signs into words, if the tokenizer is of the plain byte-level kind."""
        form = json.loads(self.tokenizer.to_str())
        cut = form["pre_tokenizer"] or {}
        plain = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
        return words_of_sure_signs() if form["normalizer"] is None and plain and form["model"]["type"] == "BPE" else None

    def encode(self, texts: list[str]) -> list[list[int] | None]:
        """Ids of each text with a blank before it, or nothing if their bytes are not the text's."""
        unsure = [i for i, t in enumerate(texts) if self.cut is None or UNSURE.search(t)]
        whole = self.tokenizer.encode_batch_fast([" " + texts[i] for i in unsure], add_special_tokens=False)
        found = {
            i: e.ids if self.spells(e.ids, b" " + texts[i].encode()) else None for i, e in zip(unsure, whole, strict=True)
        }
        return [found[i] if i in found else self._by_word(" " + t) for i, t in enumerate(texts)]

    def _merged(self, word: str) -> list[int]:
        spelled = word.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.tokenizer.model.tokenize(spelled)]
        if not self.spells(ids, word.encode()):
            raise Unspelled
        return ids

    def _by_word(self, text: str) -> list[int] | None:
        known = self.known
        try:
            ids = list(chain.from_iterable(map(known.__getitem__, self.cut(text))))
        except Unspelled:
            ids = None
        if len(known) > KNOWN_WORDS or known.letters > KNOWN_LETTERS:
            # Words in use are taken over from the memory before; the rest goes with the next.
            self.known = Known(self._merged, dict(known))
        return ids


class Pieces(Side):
    def __init__(self, path: str) -> None:
        import sentencepiece

        self.tokenizer = sentencepiece.SentencePieceProcessor(model_file=path)
        t = self.tokenizer
        size = t.get_piece_size()
        names = [t.id_to_piece(i) for i in range(size)]
        super().__init__(
            [bytes([int(n[3:5], 16)]) if t.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        )

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.tokenizer.encode(texts, num_threads=1)


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """For tokens of two coverings of the same bytes, given by their ends: the token each one's group ends with.

    Tokens of the second covering are numbered after those of the first. Of two that end together the
    first covering's is the farther.
    """
    count = len(a_ends)
    over_a = np.searchsorted(b_ends, a_ends)  # the token of the other covering at one's own last byte
    over_b = np.searchsorted(a_ends, b_ends)
    own = np.arange(count)
    to = np.concatenate([np.where(b_ends[over_a] > a_ends, over_a + count, own), over_b])
    while True:
        jumped = to[to]
        if np.array_equal(jumped, to):
            return to
        to = jumped


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


class Aligned:
    """Groups, links and digests of documents given by the ids of their two tokenisations."""

    def __init__(self, a: Side, b: Side) -> None:
        self.a, self.b = a, b
        na, nb = len(a.bytes), len(b.bytes)
        # Ids as text, followed by what separates them: between A ids, after the last, between B ids, after the last.
        text = [b"%d" % i for i in range(max(na, nb))]
        signs = [(na, b","), (na, b"|"), (nb, b","), (nb, b";")]
        self.written = np.array([t + sign for n, sign in signs for t in text[:n]], object)
        self.offsets = np.cumsum([0, na, na, nb])

    def __call__(self, a_lists: list[list[int]], b_lists: list[list[int]]):
        """Per document: groups, links, digest, pair codes (ascending) and how often each is linked."""
        docs = len(a_lists)
        a_count = np.array([len(x) for x in a_lists], np.int64)
        b_count = np.array([len(x) for x in b_lists], np.int64)
        a_ids = np.fromiter(chain.from_iterable(a_lists), np.int64, int(a_count.sum()))
        b_ids = np.fromiter(chain.from_iterable(b_lists), np.int64, int(b_count.sum()))
        a_ends, b_ends = np.cumsum(self.a.lengths[a_ids]), np.cumsum(self.b.lengths[b_ids])
        label = terminals(a_ends, b_ends)
        ends_group = label[: len(a_ids)] == np.arange(len(a_ids))
        rank = np.cumsum(ends_group) - 1
        a_group, b_group = rank[label[: len(a_ids)]], rank[label[len(a_ids) :]]
        groups = int(ends_group.sum())
        in_a, in_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        first_a, first_b = _starts(in_a), _starts(in_b)
        group_doc = np.repeat(np.arange(docs), a_count)[ends_group]
        per_doc = np.bincount(group_doc, minlength=docs)
        links = np.zeros(docs, np.int64)
        np.add.at(links, group_doc, in_a * in_b)

        codes, times = self._pairs(a_ids, b_ids, a_group, in_a, in_b, first_a, first_b, group_doc)
        cut = np.searchsorted(codes, np.arange(docs + 1) * (len(self.a.bytes) * len(self.b.bytes)))

        # Ids in the order of the digest's text: a group's A ids, then its B ids.
        order = np.empty(len(a_ids) + len(b_ids), np.int64)
        order[np.arange(len(a_ids)) + first_b[a_group]] = a_ids + self.offsets[ends_group.astype(np.int64)]
        b_last = np.zeros(len(b_ids), np.int64)
        b_last[first_b + in_b - 1] = 1
        order[np.arange(len(b_ids)) + (first_a + in_a)[b_group]] = b_ids + self.offsets[2 + b_last]
        written = self.written[order]
        at = _starts(a_count + b_count)
        for i in range(docs):
            text = b"".join(written[at[i] : at[i] + a_count[i] + b_count[i]].tolist())[:-1]
            part = slice(cut[i], cut[i + 1])
            yield int(per_doc[i]), int(links[i]), hashlib.sha256(text).hexdigest(), codes[part], times[part]

    def _pairs(self, a_ids, b_ids, a_group, in_a, in_b, first_a, first_b, group_doc):
        """Distinct (document, A id, B id) as ascending codes, and the links of each."""
        na, nb = len(self.a.bytes), len(self.b.bytes)
        wide = in_a * in_b > WIDE
        narrow = np.flatnonzero(~wide[a_group])
        partners = in_b[a_group[narrow]]
        left = np.repeat(narrow, partners)
        group = a_group[left]
        right = np.arange(len(left)) - np.repeat(_starts(partners), partners) + first_b[group]
        codes = (group_doc[group] * na + a_ids[left]) * nb + b_ids[right]
        codes, times = np.unique(codes, return_counts=True)
        if not wide.any():
            return codes, times
        more, more_times = [codes], [times]
        for g in np.flatnonzero(wide):
            ua, ca = np.unique(a_ids[first_a[g] : first_a[g] + in_a[g]], return_counts=True)
            ub, cb = np.unique(b_ids[first_b[g] : first_b[g] + in_b[g]], return_counts=True)
            more.append(((group_doc[g] * na + ua)[:, None] * nb + ub).ravel())
            more_times.append((ca[:, None] * cb).ravel())
        codes, which = np.unique(np.concatenate(more), return_inverse=True)
        times = np.zeros(len(codes), np.int64)
        np.add.at(times, which, np.concatenate(more_times))
        return codes, times


@lru_cache(1)
def _sides(a_path: str, b_path: str) -> tuple[ByteLevel, Pieces, Aligned]:
    """The two tokenizers, read once in a worker's life: those of tasks before would stay beside until their cycles are found."""
    a, b = ByteLevel(a_path), Pieces(b_path)
    return a, b, Aligned(a, b)


# A block: its documents' figures as lists, its distinct pairs and how many of its documents hold each,
# and for every document the numbers of its pairs there (as steps) with the links of each.
BLOCK = (
    "block long, doc_id array<string>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>,"
    " groups_sha256 array<string>, held array<long>, steps binary, times binary, pairs array<long>, docs array<int>"
)


def _planes(values: np.ndarray) -> bytes:
    """Numbers as bytes, all lowest bytes first; the higher ones are mostly zero, and those that all are stay away.

    Compressed here and not by Spark alone, which would sort and hand on rows of many megabytes.
    """
    planes = np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T)
    used = np.flatnonzero(planes.any(axis=1))
    return zlib.compress(planes[: used[-1] + 1 if len(used) else 0].tobytes(), 1)


def _unplaned(raw: bytes, count: int) -> np.ndarray:
    planes = np.zeros((8, count), np.uint8)
    found = np.frombuffer(zlib.decompress(raw), np.uint8)
    if len(found):
        planes[: len(found) // count] = found.reshape(-1, count)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def _block(number: int, docs: list[tuple]) -> pd.DataFrame:
    codes = [d[-2] for d in docs]
    held = np.array([len(c) for c in codes], np.int64)
    every = np.concatenate(codes)
    pairs, which, holders = np.unique(every, return_inverse=True, return_counts=True)
    steps = np.diff(which, prepend=0)
    steps[_starts(held)[held > 0]] = which[_starts(held)[held > 0]]
    row = [number, *([d[i] for d in docs] for i in range(6)), held, _planes(steps), _planes(np.concatenate([d[-1] for d in docs]))]
    row += [pairs, holders.astype(np.int32)]
    names = [c.split()[0] for c in BLOCK.split(", ")]
    return pd.DataFrame({n: [v] for n, v in zip(names, row, strict=True)})


def _blocks(a_path: str | None, b_path: str | None, batch_bytes: int, block_pairs: int):
    none = np.empty(0, np.int64)

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list]]:
        ids, texts, size = [], [], 0
        for frame in frames:
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                ids.append(doc_id)
                texts.append(text or "")
                size += len(texts[-1])
                if size >= batch_bytes:
                    yield ids, texts
                    ids, texts, size = [], [], 0
        if ids:
            yield ids, texts

    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Millions of small lists: looking for cycles costs a tenth of the time, so that is done once per block.
        gc.disable()
        try:
            yield from made(frames)
        finally:
            gc.enable()

    def made(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b, aligned = _sides(a_path or default_a(), b_path or default_b())
        size = len(a.bytes) * len(b.bytes)
        number, held, docs = TaskContext.get().partitionId() << 24, 0, []
        for ids, texts in batches(frames):
            at, a_lists, b_lists = [], [], []
            for i, (text, x, y) in enumerate(zip(texts, a.encode(texts), b.encode(texts), strict=True)):
                if text and x is not None and b.spells(y, b" " + text.encode()):
                    at.append(i)
                    a_lists.append(x)
                    b_lists.append(y)
            found = dict(zip(at, zip(a_lists, b_lists, aligned(a_lists, b_lists)), strict=True)) if at else {}
            for i, doc_id in enumerate(ids):
                if i not in found:
                    docs.append((doc_id, 0, 0, 0, 0, "", none, none))
                    continue
                x, y, (groups, links, mark, codes, times) = found[i]
                docs.append((doc_id, len(x), len(y), groups, links, mark, codes % size, times))
                held += len(codes)
            if held >= block_pairs or len(docs) >= block_pairs:
                yield _block(number, docs)
                number, held, docs = number + 1, 0, []
                # New objects' cycles; those still in use then are found by a search through all, words remembered too.
                gc.collect(1 if number % SEARCHED else 2)
                pa.default_memory_pool().release_unused()  # it would keep what texts passed through
        if docs:
            yield _block(number, docs)

    return blocks


SCORED = (
    "doc_id string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _scored(blocks: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """The documents of a block (one row), with the corpus counts of its pairs (number, count, best)."""
    block = blocks.iloc[0]
    held = np.asarray(block["held"], np.int64)
    starts = _starts(held)
    steps = _unplaned(block["steps"], int(held.sum()))
    which = np.cumsum(steps)
    if len(which):
        # Steps of a document begin anew.
        some = held > 0
        before = np.zeros(len(held), np.int64)
        before[some] = which[starts[some]] - steps[starts[some]]
        which -= np.repeat(before, held)
    times = _unplaned(block["times"], len(steps))
    count, best = np.zeros(len(counts), np.int64), np.zeros(len(counts), np.int64)
    number = counts["number"].to_numpy()
    count[number], best[number] = counts["count"].to_numpy(), counts["best"].to_numpy()

    def per_doc(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[starts + held] - total[starts]

    columns = {c: list(block[c]) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
    out = pd.DataFrame(columns | {"n_best": per_doc(times * best[which]), "count_sum": per_doc(times * count[which])})
    return out[[c.split()[0] for c in SCORED.split(", ")]]


def aligned_docs(
    docs: DataFrame,
    a_path: str | None = None,
    b_path: str | None = None,
    batch_bytes: int = BATCH_BYTES,
    block_pairs: int = BLOCK_PAIRS,
) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), and how often ids are linked.

    The second table has a row per pair: a, b, count (documents that hold it linked) and best (whether it
    is its A id's most frequent, ties included). A text is aligned with a blank before it. Texts that are
    null, empty or not spelled by both tokenizers' ids have zeros and an empty digest. Repeated rows count
    once each; null ids stay. Other columns are ignored. An empty table gives no rows.
    """
    # Ids travel as text: pandas would turn whole numbers beside nulls into floats.
    text = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    with texts_at_once(docs.sparkSession, TEXTS):
        blocks = staged(text.mapInPandas(_blocks(a_path, b_path, batch_bytes, block_pairs), BLOCK), "blocks")
    width = len(Pieces(b_path or default_b()).bytes)
    named = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "docs")).alias("number", "p"))
    named = named.select("block", "number", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))
    counts = named.groupBy("pair").agg(F.sum("docs").alias("count"))
    counts = staged(counts.withColumn("a", F.expr(f"pair div {width}")), "counts")
    # A row per id of the first vocabulary at most.
    most = F.broadcast(counts.groupBy("a").agg(F.max("count").alias("most")))
    counts = counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).cast("int").alias("best"))
    back = named.join(counts, "pair").select(F.col("block").alias("of"), "number", "count", "best")
    scored = blocks.drop("pairs", "docs").groupBy("block").cogroup(back.groupBy("of")).applyInPandas(_scored, SCORED)
    links = counts.select(F.expr(f"pair div {width}").alias("a"), (F.col("pair") % width).alias("b"), "count", F.col("best") == 1)
    return scored.withColumn("doc_id", F.col("doc_id").cast("long")), links.toDF("a", "b", "count", "best")


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned_docs(table(spark, sf_dir, "documents"))[0]
