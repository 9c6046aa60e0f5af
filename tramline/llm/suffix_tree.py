"""Language-model scores by a probabilistic suffix tree over tokens.

A state is a context of up to DEPTH tokens that precedes LEAST_STATE tokens or more and whose next-token
distribution diverges from that of its own suffix by more than its counts explain. A token is scored by
the longest suffix of what came before that is a state. Distributions are smoothed by absolute
discounting down to the root, and the root's discount is the probability of the one symbol that stands
for all tokens never seen in training.

Each state changes the logarithm of a token's probability by a number of its own: by what it leaves to
its suffix, and, for continuations it has seen, by one more. So a text's score is a sum of numbers found
by context and by context and token. All of them stand in one distributed table; the HELD most used ones
are also held where texts are read, which changes what travels but no result.

What many tokens ask for travels by groups of keys: a row holds the keys that a batch of texts has for a
group, as arrays, and each group is counted or looked up in one go.
"""

from __future__ import annotations

import itertools
import json
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import deleted, remainder, staged, table, text_or_empty, texts_at_once
from tramline.llm.near import _mixed

# Least share of all tokens that a word needs to be held where texts are read: at most 1 / LEAST_WORD words.
LEAST_WORD = 1e-6
# Longest context, least number of tokens that one precedes, and least count of a continuation of its own.
DEPTH = 3
LEAST_STATE = 8
LEAST_PAIR = 2
# Nats by which a context must describe its next tokens better than its suffix does.
DIVERGENCE = 20.0
# Taken off each count of a state other than the root.
DISCOUNT = 0.5
# Numbers of the tree held where texts are read, at most.
HELD = 300_000
# Texts that a task holds in Python at once.
TEXTS = 500
# Words that a task counts before it gives their counts away.
WAITING = 100_000
# Bits of a filter, at least and at most, and for each key; keys beyond what it can tell apart only travel for nothing.
BITS = 26
MOST_BITS = 27
BITS_PER_KEY = 8
CHUNK = 1 << 20
# Texts whose words are counted, tokens, or numbers looked up, for each group of keys; a power of two of groups is made.
TEXTS_PER_GROUP = 1 << 11
TOKENS_PER_GROUP = 1 << 20
NUMBERS_PER_GROUP = 1 << 19
# Parts of the texts scored one after the other; what one looks up is gone before the next begins.
PARTS = 2
# Bits by which keys turn from token to token, so that order counts.
TURN = 13
SEED = 42  # of Spark's xxhash64
END = np.uint64(0x98B1582B0977E704)  # xxhash64 of no bytes


def _count_words(lead: int):
    """Counts words by task; a row for each group of words, which stand in it with blanks between them."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        learned: Counter[bytes] = Counter()

        def out():
            words, n = np.array(list(learned), object), np.fromiter(learned.values(), np.int64, len(learned))
            keys = _hashes(words.tolist())[:-1]
            order = np.argsort(keys)
            group, cuts = _groups(keys[order], lead)
            words, n = words[order], n[order]
            spans = list(itertools.pairwise([*cuts.tolist(), len(n)]))
            return pd.DataFrame({"group": group, "words": [b" ".join(words[a:b]) for a, b in spans], "n": [n[a:b].tobytes() for a, b in spans]})

        for frame in frames:
            for text in frame["text"]:
                learned.update(text.encode("utf-8", "replace").lower().split())
                if len(learned) > WAITING:
                    yield out()
                    learned.clear()
        if learned:  # an empty column has no kind
            yield out()

    return count


def _word_sums(group: pd.DataFrame) -> pd.DataFrame:
    total: dict[bytes, int] = {}
    for words, n in zip(group["words"], group["n"], strict=True):
        for word, c in zip(words.split(), np.frombuffer(n, np.int64).tolist(), strict=True):
            total[word] = total.get(word, 0) + c
    return pd.DataFrame({"word": list(total), "symbol": _hashes(list(total))[:-1].view(np.int64), "c": list(total.values())})


@dataclass(frozen=True)
class Words:
    """Frequent words, most frequent first, with counts; what follows needs the place in this list only."""

    names: list[bytes]
    counts: np.ndarray
    tokens: int  # in training texts, ends included
    distinct: int
    texts: int
    once: int  # words seen once, and twice
    twice: int

    @property
    def end(self) -> int:
        """The end of a text as a symbol; it is also the token before the first."""
        return len(self.names)

    def discount(self) -> float:
        """Taken off each count at the root, from how many words were seen once and twice."""
        return min(max(self.once / (self.once + 2 * self.twice), 0.1), 0.9) if self.once else 0.5

    def unseen(self) -> float:
        """Root probability of all unseen tokens together."""
        return self.discount() * self.distinct / self.tokens if self.tokens else 1.0

    def root(self, counts: np.ndarray) -> np.ndarray:
        """Root probability of tokens with these training counts, 0 for a token never seen."""
        return np.where(counts > 0, (counts - self.discount()) / max(self.tokens, 1), self.unseen())


def _places(tokens: list[bytes], at: dict[bytes, int], end: int) -> np.ndarray:
    """For each token and the end its place among the frequent words, -1 for others."""
    return np.append(np.fromiter(map(at.get, tokens, repeat(-1)), np.int64, len(tokens)), end)


def _hashes(tokens: list[bytes]) -> np.ndarray:
    """Hash of each token and of the end, as Spark's xxhash64 gives it."""
    import xxhash

    found = np.fromiter(map(xxhash.xxh64_intdigest, tokens, repeat(SEED)), np.uint64, len(tokens))
    return np.append(found, END)


def _stream(texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each with its end, and the place of each token in its text."""
    hashes = [_hashes(text.encode("utf-8", "replace").lower().split()) for text in texts]
    return np.concatenate(hashes), _inside(np.fromiter(map(len, hashes), np.int64, len(hashes)))


def _inside(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of the sizes."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _levels(h: np.ndarray, place: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For contexts of 1 to ``depth`` tokens in a stream of texts: key of each, key of its suffix, what follows, and where.

    A context's key is that of its last token after the others, so its count is already known from there.
    The end of the text before stands before a text's first token, as its own end does.
    """
    state, suffix = np.concatenate([[END], h[:-1]]), np.zeros(len(h), np.uint64)
    yield state, suffix, h, np.arange(len(h))
    for size in range(2, depth + 1):
        state, suffix = np.concatenate([[END], _after(state[:-1], h[:-1])]), state
        at = np.flatnonzero(place >= size - 1)
        yield state[at], suffix[at], h[at], at


def _after(state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Key of a token after a context."""
    return ((state << np.uint64(TURN)) | (state >> np.uint64(64 - TURN))) ^ symbol


def _after_column(state: Column, symbol: Column) -> Column:
    return F.shiftleft(state, TURN).bitwiseOR(F.shiftrightunsigned(state, 64 - TURN)).bitwiseXOR(symbol)


def _bits(bits: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mixed, width = _mixed(keys), len(bits).bit_length() + 2
    return (mixed & np.uint64((1 << width) - 1)).astype(np.int64), (mixed >> np.uint64(64 - width)).astype(np.int64)


def _mark(bits: np.ndarray, keys: np.ndarray) -> None:
    for place in _bits(bits, keys):
        np.bitwise_or.at(bits, place >> 3, np.left_shift(1, place & 7).astype(np.uint8))


def _filter(keys: DataFrame) -> np.ndarray:
    """A filter that lets all ``keys`` (one column of longs) through; it grows with them up to MOST_BITS."""
    name = keys.columns[0]
    width = min(max((BITS_PER_KEY * keys.count()).bit_length(), BITS), MOST_BITS)

    def fill(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros(1 << (width - 3), np.uint8)
        for frame in frames:
            _mark(bits, frame[name].to_numpy(np.int64).view(np.uint64))
        at = np.arange(0, len(bits), CHUNK)
        yield pd.DataFrame({"at": at, "bits": [bits[a : a + CHUNK].tobytes() for a in at]})

    def either(chunk: pd.DataFrame) -> pd.DataFrame:
        bits = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in chunk["bits"]])
        return pd.DataFrame({"at": chunk["at"][:1], "bits": [bits.tobytes()]})

    filled = keys.coalesce(4).mapInPandas(fill, "at long, bits binary").groupBy("at").applyInPandas(either, "at long, bits binary")
    out = np.zeros(1 << (width - 3), np.uint8)
    for row in filled.collect():  # one filter
        out[row["at"] : row["at"] + CHUNK] = np.frombuffer(row["bits"], np.uint8)
    return out


def _grouped_by(rows: int, per_group: int) -> int:
    """Leading bits of a key that tell its group."""
    return max(0, (rows - 1) // per_group).bit_length()


def _groups(ascending: np.ndarray, lead: int) -> tuple[np.ndarray, np.ndarray]:
    """The groups of keys, and where each begins."""
    group = ((ascending >> np.uint64(1)) >> np.uint64(63 - lead)).astype(np.int64)
    cuts = _firsts(group) if len(group) else np.zeros(0, np.int64)
    return group[cuts], cuts


def _packed(keys: np.ndarray, lead: int, columns: dict[str, np.ndarray]) -> pd.DataFrame:
    """One row per group of the ``keys``, which ascend, with its part of each of the ``columns`` as bytes."""
    group, cuts = _groups(keys, lead)
    spans = list(itertools.pairwise([*cuts.tolist(), len(keys)])) if len(cuts) else []
    return pd.DataFrame({"group": group} | {name: [x[a:b].tobytes() for a, b in spans] for name, x in columns.items()})


def _unpacked(column: pd.Series, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind)


def _passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    a, b = _bits(bits, keys)
    return ((bits[a >> 3] >> (a & 7).astype(np.uint8)) & (bits[b >> 3] >> (b & 7).astype(np.uint8)) & 1).astype(bool)


def _firsts(ascending: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], ascending[1:] != ascending[:-1]]))


def _count_pairs(size: int, bits: np.ndarray, lead: int):
    """Counts what follows contexts of ``size`` tokens, of those that ``bits`` let through; a row for each group of pairs."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, ...]] = []
        waiting = 0

        def out():
            state, suffix, symbol = (np.concatenate(x) for x in zip(*held, strict=True))
            key = _after(state, symbol)
            order = np.argsort(key)
            key = key[order]
            first = _firsts(key)
            at, n = order[first], np.diff(np.append(first, len(key))).astype(np.int32)
            # Within a group by state, as equal numbers side by side are packed well.
            key = (key[first] & ~np.uint64((1 << (64 - lead)) - 1)) | (state[at] >> np.uint64(lead))
            order = np.argsort(key)
            at = at[order]
            return _packed(key[order], lead, {"state": state[at], "suffix": suffix[at], "symbol": symbol[at], "n": n[order]})

        for frame in frames:
            *_, (state, suffix, symbol, _) = _levels(*_stream(frame["text"]), size)
            use = _passes(bits, state)
            held.append((state[use], suffix[use], symbol[use]))
            waiting += len(held[-1][0])
            if waiting > 1_000_000:
                yield out()
                held, waiting = [], 0
        if waiting:
            yield out()

    return count


PAIRS = "state long, suffix long, symbol long, n long"


def _pair_sums(group: pd.DataFrame) -> pd.DataFrame:
    """The pairs of a group that were counted LEAST_PAIR times or more in all."""
    columns = {name: _unpacked(group[name], np.uint64) for name in ("state", "suffix", "symbol")}
    n = _unpacked(group["n"], np.int32).astype(np.int64)
    key = _after(columns["state"], columns["symbol"])
    order = np.argsort(key)
    first = _firsts(key[order])
    n = np.add.reduceat(n[order], first)
    keep = n >= LEAST_PAIR
    at = order[first[keep]]
    return pd.DataFrame({name: x[at].view(np.int64) for name, x in columns.items()} | {"n": n[keep]})


def _grown(training: DataFrame, counted: DataFrame, words: Words, divergence: float, depth: int) -> DataFrame:
    """key, value, n: what each state and each of its continuations adds to the logarithm of a probability."""
    ends = training.sparkSession.range(1).select(F.lit(int(END.view(np.int64))).alias("symbol"), F.lit(words.texts).cast("long").alias("c"))
    counts = counted.select("symbol", "c").unionByName(ends.filter("c > 0"))
    last = staged(counts.select("symbol", ((F.col("c") - words.discount()) / max(words.tokens, 1)).alias("lower")), "root")
    lower = last
    totals, on, parts = counts.filter(F.col("c") >= LEAST_STATE).select(F.col("symbol").alias("state"), F.col("c").alias("t")), ["symbol"], []
    totals = staged(totals, "totals")
    key = _after_column(F.col("state"), F.col("symbol"))
    for size in range(1, depth + 1):
        count = _count_pairs(size, _filter(totals.select("state")), _grouped_by(words.tokens, TOKENS_PER_GROUP))
        pairs = training.mapInPandas(count, "group long, state binary, suffix binary, symbol binary, n binary")
        pairs = pairs.groupBy("group").applyInPandas(_pair_sums, PAIRS)
        # What follows a context LEAST_PAIR times follows its suffix as often, so it is found there.
        with texts_at_once(training.sparkSession, TEXTS):
            pairs = staged(pairs, "pairs")  # by itself, so that its shuffle is gone when the pairs travel
        kept = staged(pairs.join(lower, on), "kept")
        sums = kept.groupBy("state").agg(
            F.sum(F.col("n") * F.log(F.col("n") / F.col("lower"))).alias("g"),
            F.sum("n").alias("k"),
            F.sum(F.col("n") - DISCOUNT).alias("own"),
            F.sum("lower").alias("l"),
        )
        # All other continuations count as one, so this is a lower bound of the divergence.
        rest = F.col("t") - F.col("k")
        other = F.when(rest > 0, rest * F.log(rest / F.col("t") / F.greatest(1 - F.col("l"), F.lit(1e-12)))).otherwise(0.0)
        states = totals.join(sums, "state").withColumn("gain", F.col("g") - F.col("k") * F.log("t") + other)
        states = staged(states.select("state", "t", (1 - F.col("own") / F.col("t")).alias("left"), (F.col("gain") >= divergence).alias("is")), "states")
        grown = kept.join(states, "state")
        grown = grown.withColumn("p", F.when(F.col("is"), (F.col("n") - DISCOUNT) / F.col("t") + F.col("left") * F.col("lower")).otherwise(F.col("lower")))
        grown = staged(grown.select("state", "symbol", "n", "is", "left", "lower", "p"), "grown")
        added = F.log10("p") - F.log10("lower") - F.log10("left")
        part = states.filter("is").select(F.bitwise_not("state").alias("key"), F.log10("left").alias("value"), F.col("t").alias("n"))
        parts.append(staged(part.unionByName(grown.filter("is").select(key.alias("key"), added.alias("value"), "n")), "tree"))
        spent = (totals, pairs, kept, states, last)
        totals = staged(grown.filter(F.col("n") >= LEAST_STATE).select(key.alias("state"), F.col("n").alias("t")), "totals")
        deleted(*spent)
        last, lower, on = grown, grown.select(F.col("state").alias("suffix"), "symbol", F.col("p").alias("lower")), ["suffix", "symbol"]
    deleted(totals, last)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _most_used(tree: DataFrame, held: int) -> tuple[DataFrame, DataFrame]:
    """At most ``held`` numbers of the tree, those used most, and the others.

    Uses are told apart by 64 steps for each doubling, so the driver sees a few thousand counts however large the tree.
    """
    step = F.floor(64 * F.log2("n"))
    counts = sorted(((r["s"], r["k"]) for r in tree.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("k")).collect()), reverse=True)
    least = counts[0][0] + 1 if counts else 0
    for s, k in counts:
        held -= k
        if held < 0:
            break
        least = s
    return tree.filter(step >= least), tree.filter(step < least)


def _read(words: Words, held: pd.DataFrame, bits: np.ndarray, depth: int):
    """Sums what is held of a batch of texts, and names what must be looked up: rare words, and keys that ``bits`` let through.

    Both come as keys and the places of their texts in the batch.
    """
    held_keys = held["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(held_keys)
    held_keys, held_values = held_keys[order], held["value"].to_numpy(float)[order]

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        near = np.zeros(1 << (BITS - 3), np.uint8)
        _mark(near, held_keys)
        at = {w: i for i, w in enumerate(words.names)}
        counts = np.append(words.counts, words.texts)
        hashes = _hashes(words.names)
        base = np.log10((counts + 1) / (words.tokens + words.distinct + 1))
        root = np.log10(words.root(counts.astype(float)))
        for frame in frames:
            texts = [text.encode("utf-8", "replace").lower().split() for text in frame["text"]]
            places = np.concatenate([_places(tokens, at, words.end) for tokens in texts])
            sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
            row, place = np.repeat(np.arange(len(texts)), sizes), _inside(sizes)
            others = np.flatnonzero(places < 0)
            h = hashes[places]
            h[others] = _hashes([texts[r][p] for r, p in zip(row[others].tolist(), place[others].tolist(), strict=True)])[:-1]
            known = np.flatnonzero(places >= 0)
            count = lambda values, at, row=row, n=len(texts): np.bincount(row[at], values, n)
            score = count(root[places[known]], known)
            keys, owners = [h[others]], [row[others]]
            for state, _, symbol, where in _levels(h, place, depth):
                # A continuation is in the tree only if its context is.
                is_near, is_far = _passes(near, ~state), _passes(bits, ~state)
                use = np.flatnonzero(is_near | is_far)
                after = _after(state[use], symbol[use])
                for maybe, owner in ((~state[is_near], where[is_near]), (after, where[use])):
                    pick = _passes(near, maybe)
                    maybe, owner = maybe[pick], owner[pick]
                    if len(held_keys) and len(maybe):
                        found = np.minimum(np.searchsorted(held_keys, maybe), len(held_keys) - 1)
                        hit = held_keys[found] == maybe
                        score += count(held_values[found[hit]], owner[hit])
                pick = _passes(bits, after)
                keys += [~state[is_far], after[pick]]
                owners += [row[where[is_far]], row[where[use[pick]]]]
            yield (
                pd.DataFrame(
                    {
                        "doc_id": frame["doc_id"],
                        "held_out": frame["held_out"],
                        "n_tokens": sizes,
                        "n_known": count(counts[places[known]] > 0, known).astype(np.int64),
                        "base": count(base[places[known]], known),
                        "score": score,
                    }
                ),
                (keys[0], owners[0]),
                (np.concatenate(keys[1:]), np.concatenate(owners[1:])),
            )

    return read


def _score(words: Words, held: pd.DataFrame, bits: np.ndarray, depth: int):
    """What ``_read`` finds, as rows: by text its sums and its keys, those of the tree counted below zero."""

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for texts, rare, far in _read(words, held, bits, depth)(frames):
            keys, owners = (np.concatenate(x) for x in zip(rare, far, strict=True))
            kinds, order = np.repeat([1, -1], [len(rare[0]), len(far[0])]), np.argsort(owners, kind="stable")
            cuts = np.cumsum(np.bincount(owners, minlength=len(texts)))[:-1]
            yield texts.assign(keys=np.split(keys[order].view(np.int64), cuts), counts=np.split(kinds[order], cuts))

    return score


def scored_texts(docs: DataFrame, held_out: Column, divergence: float = DIVERGENCE, depth: int = DEPTH, held: int = HELD) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words, A to Z in lower case, then one end. The tree and the counts come from rows
    that are not ``held_out``. A null or empty text is the end alone. Repeated rows and null ids stay,
    each scored by itself. Without training rows nothing is known, and the symbol for the unseen has
    all probability. Other columns are ignored. An empty table gives no rows.

    The driver and the tasks hold the frequent words, at most ``held`` numbers of the tree and filters of
    fixed size, whatever the input. All other words and numbers are looked up after a shuffle by key. Keys
    are hashes of 64 bits.
    """
    # Ids travel as text: pandas would turn whole numbers beside nulls into floats.
    rows = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"), text_or_empty(docs["text"]).alias("text"), held_out.alias("held_out")
    )
    training = rows.filter(~F.col("held_out")).select("text")
    texts = training.count()
    counted = training.mapInPandas(_count_words(_grouped_by(texts, TEXTS_PER_GROUP)), "group long, words binary, n binary")
    counted = counted.groupBy("group").applyInPandas(_word_sums, "word binary, symbol long, c long")
    with texts_at_once(docs.sparkSession, TEXTS):
        counted = staged(counted, "words")
    return _learned_and_scored(rows, training, texts, counted, divergence, depth, held)


def _learned_and_scored(rows: DataFrame, training: DataFrame, texts: int, counted: DataFrame, divergence: float, depth: int, held: int) -> DataFrame:
    sums = counted.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
        F.count(F.lit(1)).alias("v"),
        F.count(F.when(F.col("c") == 1, 1)).alias("once"),
        F.count(F.when(F.col("c") == 2, 1)).alias("twice"),
    ).first()
    tokens = sums["n"] + texts
    is_frequent = F.col("c") >= max(1.0, LEAST_WORD * tokens)
    frequent = counted.filter(is_frequent).select("word", "c").toArrow()  # at most 1 / LEAST_WORD
    frequent = sorted(zip(frequent["c"].to_pylist(), frequent["word"].to_pylist(), strict=True), reverse=True)
    words = Words(
        [word for _, word in frequent],
        np.array([c for c, _ in frequent], np.int64),
        tokens,
        sums["v"] + int(texts > 0),
        texts,
        sums["once"],
        sums["twice"],
    )
    tree = _grown(training, counted, words, divergence, depth)
    top, far = _most_used(tree, held)
    top = top.select("key", "value").toArrow().to_pandas()  # at most ``held`` rows

    rare = counted.filter(~is_frequent)
    looked = rare.select(F.col("symbol").alias("key"), F.lit(True).alias("is_word"), F.col("c").cast("double").alias("value"))
    looked = looked.unionByName(far.select("key", F.lit(False).alias("is_word"), "value"))
    lead = _grouped_by(looked.count(), NUMBERS_PER_GROUP)
    looked = staged(looked.mapInPandas(_numbers(lead), "group long, is_word boolean, key binary, value binary"), "looked")
    score = _dealt(_read(words, top, _filter(far.select("key")), depth), lead)
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(PARTS))
    with texts_at_once(rows.sparkSession, TEXTS):
        scores = [staged(_summed(rows.filter(part == i).mapInPandas(score, SENT), looked, words), "scores") for i in range(PARTS)]
    deleted(counted, tree, looked)
    out = scores[0]
    for more in scores[1:]:
        out = out.unionByName(more)
    return out


def _numbers(lead: int):
    """Packs rows of ``key``, ``is_word``, ``value`` by group."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, waiting = [], 0
        for frame in frames:
            held.append((frame["key"].to_numpy(np.int64).view(np.uint64), frame["is_word"].to_numpy(bool), frame["value"].to_numpy(float)))
            waiting += len(frame)
            if waiting > 1_000_000:
                yield from out(held)
                held, waiting = [], 0
        if waiting:
            yield from out(held)

    def out(held):
        keys, is_word, value = (np.concatenate(x) for x in zip(*held, strict=True))
        for kind in (True, False):
            own = np.flatnonzero(is_word == kind)
            own = own[np.argsort(keys[own])]
            yield _packed(keys[own], lead, {"key": keys[own], "value": value[own]}).assign(is_word=kind)

    return pack


# Either what a batch of texts looks up in a group of keys, or the texts' own ids and sums.
OWN = np.dtype([("held_out", bool), ("n_tokens", np.int64), ("n_known", np.int64), ("base", float), ("score", float)])
SENT = "batch long, group long, is_word boolean, row binary, key binary, ids binary, own binary"


def _dealt(read, lead: int):
    """What texts look up, dealt by groups of keys; ``row`` is a text's place in its batch."""

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()  # a task that is run again names its batches alike
        for i, (texts, *asked) in enumerate(read(frames)):
            own = np.empty(len(texts), OWN)
            for name in OWN.names:
                own[name] = texts[name]
            ids = json.dumps([x if isinstance(x, str) else None for x in texts["doc_id"]]).encode()
            parts = [pd.DataFrame({"group": [(task + i) % (1 << lead)], "ids": [ids], "own": [own.tobytes()]})]
            for is_word, (keys, row) in zip((True, False), asked, strict=True):
                order = np.argsort(keys)
                keys, row = keys[order], row[order].astype(np.int32)
                parts.append(_packed(keys, lead, {"row": row, "key": keys}).assign(is_word=is_word))
            for part in parts:
                yield part.reindex(columns=["group", "is_word", "row", "key", "ids", "own"]).assign(batch=(task << 32) + i)

    return deal


MET = "batch long, group long, is_word boolean, row binary, known binary, base binary, score binary, ids binary, own binary"


def _met(words: Words):
    """Looks up what all batches ask of a group, and sums it by text."""

    def meet(asked: pd.DataFrame, numbers: pd.DataFrame) -> pd.DataFrame:
        own = asked[asked["ids"].notna()]
        parts = [own[["batch", "group", "ids", "own"]]]
        for kind in (True, False):
            of = asked[asked["ids"].isna() & (asked["is_word"] == kind)]
            if of.empty:
                continue
            keys, row = _unpacked(of["key"], np.uint64), _unpacked(of["row"], np.int32)
            batch = np.repeat(np.arange(len(of)), of["key"].map(len).to_numpy() // 8)
            table = numbers[numbers["is_word"] == kind]
            table_keys, values = _unpacked(table["key"], np.uint64), _unpacked(table["value"], float)
            order = np.argsort(table_keys)
            table_keys, values = np.append(table_keys[order], np.uint64(0)), np.append(values[order], 0.0)
            found = np.searchsorted(table_keys[:-1], keys)
            hit = (table_keys[found] == keys) & (found < len(order))
            value = np.where(hit, values[found], 0.0)
            if kind:  # a word that is not found was never seen
                base, score = np.log10((value + 1) / (words.tokens + words.distinct + 1)), np.log10(words.root(value))
            else:
                row, batch, base, score, hit = row[hit], batch[hit], np.zeros(0), value[hit], np.zeros(0)
            spot, at = np.unique((batch << 32) | row, return_inverse=True)
            sums = {"row": (spot & 0xFFFFFFFF).astype(np.int32), "score": np.bincount(at, score, len(spot))}
            if kind:
                sums |= {"known": np.bincount(at, hit, len(spot)), "base": np.bincount(at, base, len(spot))}
            cuts = np.searchsorted(spot >> 32, np.arange(len(of) + 1)).tolist()
            packed = {name: [x[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)] for name, x in sums.items()}
            parts.append(pd.DataFrame({"batch": of["batch"].to_numpy(), "group": of["group"].to_numpy(), "is_word": kind} | packed))
        columns = ["batch", "group", "is_word", "row", "known", "base", "score", "ids", "own"]
        return pd.concat([part.reindex(columns=columns).astype(object) for part in parts], ignore_index=True)

    return meet


def _added_up(batch: pd.DataFrame) -> pd.DataFrame:
    """The scores of a batch of texts: their own sums and those of all groups, in the groups' order."""
    own = batch[batch["ids"].notna()].iloc[0]
    ids, columns = json.loads(own["ids"]), np.frombuffer(own["own"], OWN)
    asked = batch[batch["ids"].isna()].sort_values(["is_word", "group"])
    of_words, n = asked[asked["is_word"].astype(bool)], len(ids)
    add = lambda rows, name: np.bincount(_unpacked(rows["row"], np.int32), _unpacked(rows[name], float), n)
    return pd.DataFrame(
        {
            "doc_id": ids,
            "held_out": columns["held_out"],
            "n_tokens": columns["n_tokens"],
            "n_known": columns["n_known"] + add(of_words, "known").astype(np.int64),
            "base_score": columns["base"] + add(of_words, "base"),
            "score": columns["score"] + add(asked, "score"),
        }
    )


def _summed(sent: DataFrame, looked: DataFrame, words: Words) -> DataFrame:
    """The scores of texts that ``_read`` has read, with what they look up."""
    met = sent.groupBy("group").cogroup(looked.groupBy("group")).applyInPandas(_met(Words([], np.zeros(0, np.int64), *_totals(words))), MET)
    summed = met.groupBy("batch").applyInPandas(
        _added_up, "doc_id string, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return summed.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def _totals(words: Words) -> tuple[int, ...]:
    return words.tokens, words.distinct, words.texts, words.once, words.twice


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored_texts(docs, remainder(docs["doc_id"], 7) == 2)
