"""Toxicity of texts restored from disguised spellings by a noisy-channel decoder.

A writer is taken to have put a plain word through a channel that swaps letters for look-alikes, puts
signs between letters and repeats letters. A Viterbi search over the lattice of what each character
may have been finds the word that is likeliest under a character language model of the corpus. A sign may
also have stood in the plain text, so numbers and punctuation are one of the paths. Every token with a
look-alike, a sign between letters or a repeated letter is decoded, and every run of fragments of one
or two letters; other tokens have a lattice of one path and pass as they are. The restored text is scored by words and word beginnings that labelled documents show to be toxic.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm.common import deleted, remainder, staged, table, text_or_empty
from tramline.llm.near import near_classes

# Letters that a sign or digit may stand for.
LOOK_ALIKES = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "gb",
    "7": "t",
    "8": "b",
    "9": "gq",
    "@": "a",
    "$": "s",
    "!": "il",
    "|": "il",
    "+": "t",
    "*": "aeiou",
    "#": "aeiou",
    "а": "a",
    "е": "e",
    "о": "o",
    "р": "p",
    "с": "c",
    "у": "y",
    "х": "x",
    "і": "i",
}
FILLERS = " .-_*~'"
# Characters without width, put between letters.
UNSEEN = "\u00ad\u200b\u200c\u200d"

# Alphabet of the language model: 0 is any word boundary, 1 a letter not listed.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xDF, 0x100)))
SIZE = len(LETTERS) + 2

# Costs in nats of what the channel did.
SWAPPED, LOST_SIGN, FILLED, WORD_GAP, REPEATED, DOUBLED = 0.5, 9.0, 0.3, 6.0, 0.2, 4.0
# A look-alike that stood in the plain text, beside letters and in a number; a sign between letters put in, and
# a gap between longer fragments.
MEANT, NUMBER, PARTED, SHORT_GAP = 6.0, 0.5, 1.0, 0.0
BEAM = 48

# Labelled rows the model is fitted on, at most; taken by the hash of their id.
FIT_ROWS = 20_000
# Features considered, by how many toxic documents have them.
FIT_FEATURES = 50_000
THRESHOLD = 0.7
PREFIXES = range(4, 8)
# Toxic texts whose shingles have this similarity, in tenths, count as one when words are learned.
SIMILAR = 3

WORD = re.compile(r"[^\W\d_]+")
TOKEN = re.compile(r"\S+")
EDGES = ".,;:?\"()[]{}<>%&"
_L = r"[^\W\d_]"
# Four or more letters one by one, or fragments of one or two, with up to three signs or blanks between.
_F, _G = r"(?:[^\W_]|[@$!|+*#])", r"[\W_]{1,3}?"
SPACED = re.compile(rf"(?<!\w){_F}(?:{_G}{_F}(?!\w)){{3,}}")
FRAGMENTS = re.compile(rf"(?<!\w){_F}{{1,2}}(?:{_G}{_F}{{1,2}}(?!\w)){{3,}}")
# A look-alike or unseen sign, signs between letters, or a letter repeated.
BETWEEN = "\n\n\n"
SIGNS = "".join(re.escape(c) for c in LOOK_ALIKES) + UNSEEN
SUSPECT = re.compile(rf"[{SIGNS}]|({_L})\1|{_L}[\W_]+{_L}")
SUSPECT_LETTER = re.compile(f"[{''.join(c for c in LOOK_ALIKES if c.isalpha())}]")
ONLY_LETTERS = re.compile(rf"{_L}+")
GAPS = re.compile(r"\s+")
TRIPLE = re.compile(r"(.)\1\1")
PAIR, DOUBLES = re.compile(rf"({_L})\1"), re.compile(rf"(?:({_L})\1){{3,}}")
# Signs at the end of a token that may well be punctuation.
CLOSING = re.compile(r"(?:!+|([$*#+|@])\1+)$")
# Doubled letters of a word that are tried together.
MOST_PAIRS = 4


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the model's letter, and 0 blank, 1 letter, 2 look-alike or unseen, 3 filler, 4 other."""
    letter, kind = np.zeros(0x110000, np.uint8), np.full(0x110000, 4, np.uint8)
    for point in range(0x250):
        if chr(point).isalpha():
            letter[point] = 1
    letter[0x250:0x2000] = 1
    every = np.arange(0x110000, dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")
    for pattern, which in ((ONLY_LETTERS, 1), (GAPS, 0)):
        for run in pattern.finditer(every):
            kind[run.start() : run.end()] = which
    for i, c in enumerate(LETTERS):
        letter[ord(c)] = i + 2
    for c in LOOK_ALIKES:
        kind[ord(c)] = 2
    for c in UNSEEN:
        kind[ord(c)] = 2
    for c in FILLERS.strip():
        kind[ord(c)] = 2 if c in LOOK_ALIKES else 3
    return letter, kind


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _count_trigrams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    letter, _ = _classes()
    counts = np.zeros(SIZE**3, np.int64)
    for frame in frames:
        for start in range(0, len(frame), 64):
            texts = [f"  {text.lower()} " for text in frame["text"][start : start + 64] if text]
            if texts:
                c = letter[_points("".join(texts))].astype(np.int32)
                codes = (c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:]
                ends = np.cumsum([len(text) for text in texts])[:-1]
                counts += np.bincount(np.delete(codes, np.concatenate([ends - 2, ends - 1])), minlength=SIZE**3)
    some = np.flatnonzero(counts)
    yield pd.DataFrame({"code": some, "n": counts[some]})


def letter_model(texts: DataFrame) -> np.ndarray:
    """Cost in nats of each letter after any two, from the letters of all ``texts``.

    The driver receives one sum per combination of three letters of a fixed alphabet, however large
    the corpus. Trigrams, bigrams and single letters are mixed, so every letter is possible.
    """
    rows = texts.mapInPandas(_count_trigrams, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    three = np.zeros(SIZE**3)
    for row in rows.collect():  # at most SIZE ** 3 numbers
        three[row["code"]] = row["n"]
    three = three.reshape(SIZE, SIZE, SIZE)
    three[0, 0, 0] = 0  # blanks after blanks
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p = (one + 1) / (one.sum() + SIZE)
    p = (two + 10 * p) / (two.sum(axis=1, keepdims=True) + 10)
    p = (three + 10 * p) / (three.sum(axis=2, keepdims=True) + 10)
    return -np.log(p)


def _learned_word(word: str, words: Collection[str]) -> bool:
    return f"{word} " in words or any(word[:n] in words for n in PREFIXES if n < len(word))


def _spelled(path: tuple | None) -> str:
    letters = []
    while path is not None:
        letters.append(path[0])
        path = path[1]
    return "".join(reversed(letters))


class Decoder:
    """Restores disguised words; remembers what it has decoded, up to so many entries and letters of each kind."""

    REMEMBERED, LETTERS, SIGNS = 50_000, 2_000_000, 10_000

    def __init__(self, costs: np.ndarray, words: Collection[str] = ()):
        self.costs = costs.reshape(-1, SIZE).tolist()
        self.words = words
        self.code = {c: i + 2 for i, c in enumerate(LETTERS)}
        self.known: dict[str, str] = {}
        self.tokens: dict[str, str] = {}
        self.ends: dict[str, str] = {}
        self.letters = {id(self.known): 0, id(self.tokens): 0, id(self.ends): 0}
        self.begins = {w[:n] for w in words for n in (1, 2)}
        self.lattice: dict[tuple, list[tuple[str, int, float]]] = {}

    def _remember(self, memory: dict[str, str], key: str, found: str) -> str:
        used = self.letters[id(memory)] + len(key) + len(found)
        if len(memory) >= self.REMEMBERED or used > self.LETTERS:
            memory.clear()
            used = len(key) + len(found)
        memory[key], self.letters[id(memory)] = found, used
        return found

    def options(self, sign: str, run: int, put: float, gap: float, meant: float) -> list[tuple[str, float]]:
        """Letters that ``sign`` may have been, with costs; an empty one if it was put in.

        ``run`` counts equal letters around a repeated one, or is 0; ``put`` and ``gap`` are the costs of a
        filler that was put in and of one that was there, and ``meant`` of a look-alike that was.
        """
        if sign in UNSEEN:
            return [("", FILLED)]
        swaps = [(c, SWAPPED) for c in LOOK_ALIKES.get(sign, "")]
        if swaps:
            kept = [] if sign.isalpha() else [(sign, meant)]
            return [*swaps, *kept, ("", FILLED if meant == MEANT and run > 1 or sign in FILLERS else LOST_SIGN)]
        if sign.isalpha():
            return [(sign, 0.0)] + ([("", REPEATED if run > 2 else DOUBLED)] if run else [])
        return [("", put), (" " if sign.isspace() else sign, gap)]

    def numbered(self, sign: str, run: int, put: float, gap: float, meant: float) -> list[tuple[str, int, float]]:
        """``options`` with the model's letter between them, -1 for the empty one; remembered for the signs in use."""
        key = (sign, min(run, 3), put, gap, meant)
        found = self.lattice.get(key)
        if found is None:
            if len(self.lattice) >= self.SIGNS:
                self.lattice.clear()
            options = self.options(sign, min(run, 3), put, gap, meant)
            number = lambda c: self.code.get(c, 1 if c.isalpha() else 0) if c else -1
            found = self.lattice[key] = [(c, number(c), extra) for c, extra in options]
        return found

    def undoubled(self, word: str) -> str:
        """``word`` with as few doubled letters written once as make it a learned word, if any do.

        Letters alone do not tell: many plain words have pairs that are as rare as a disguise.
        """
        # The first two letters stay whichever are taken out, but for a pair of them.
        if word[: 1 if word[:1] == word[1:2] else 2] not in self.begins or _learned_word(word, self.words):
            return word
        pairs = [m.start() for m in PAIR.finditer(word)][:MOST_PAIRS]
        for size in range(1, len(pairs) + 1):
            for gone in combinations(pairs, size):
                other = "".join(c for i, c in enumerate(word) if i not in gone)
                if _learned_word(other, self.words):
                    return other
        return word

    def decode(self, span: str) -> str:
        """The likeliest plain spelling of ``span``, by Viterbi search over two letters of history."""
        found = self.known.get(span)
        if found is None:
            found = self._remember(self.known, span, self._search(span))
        return found

    def _search(self, span: str) -> str:
        runs = [len(m[0]) for m in re.finditer(r"(.)\1*", span, re.S) for _ in m[0]]
        doubled = DOUBLES.fullmatch(span) is not None
        fragments = re.findall(r"[^\W_]+", span)
        one_by_one = len(fragments) > 2 and max(map(len, fragments)) == 1
        put, gap = (FILLED, WORD_GAP) if one_by_one else (PARTED, SHORT_GAP)
        meant = MEANT if any(map(str.isalpha, span)) else NUMBER
        closing = end.start() if (end := CLOSING.search(span)) else len(span)
        choices = []
        for i, sign in enumerate(span):
            repeat = i > 0 and span[i - 1] == sign
            choices.append(self.numbered(sign, (3 if doubled else runs[i]) if repeat else 0, put, gap, 0.0 if i >= closing else meant))
        beam = self._follow({0: (0.0, None)}, choices[:closing])
        if closing == len(span) or len(beam) > 1:
            return self._likeliest(self._follow(beam, choices[closing:]))
        # From a single state on, the signs at the end alone decide.
        ((state, (_, path)),) = beam.items()
        key = f"{state} {put} {gap} {span[closing:]}"
        end = self.ends.get(key)
        if end is None:
            end = self._remember(self.ends, key, self._likeliest(self._follow({state: (0.0, None)}, choices[closing:])))
        return _spelled(path) + end

    def _follow(self, beam: dict[int, tuple[float, tuple | None]], choices: list[list[tuple[str, int, float]]]) -> dict[int, tuple[float, tuple | None]]:
        """The best way to each state after ``choices``; a state is the last two letters of the model, as one number."""
        for options in choices:
            following: dict[int, tuple[float, tuple | None]] = {}
            for state, (cost, path) in beam.items():
                row, q = self.costs[state], state % SIZE
                for letter, c, extra in options:
                    if c < 0 or not c and not q:  # one boundary, however many signs
                        key, total = state, cost + extra
                    else:
                        key, total = q * SIZE + c, cost + extra + row[c]
                    best = following.get(key)
                    if best is None or total < best[0]:
                        following[key] = (total, path if c < 0 else (letter, path))
            if len(following) > BEAM:
                following = dict(sorted(following.items(), key=lambda x: x[1][0])[:BEAM])
            beam = following
        return beam

    def _likeliest(self, beam: dict[int, tuple[float, tuple | None]]) -> str:
        ways = [(cost + (self.costs[state][0] if state % SIZE else 0.0), i, path) for i, (state, (cost, path)) in enumerate(beam.items())]
        return _spelled(min(ways)[2])

    def token(self, word: str) -> str:
        """A token of a text, decoded if anything in it is suspicious."""
        found = self.tokens.get(word)
        if found is None:
            core, found = word.strip(EDGES), word
            if SUSPECT.search(core):
                pairs = ONLY_LETTERS.fullmatch(core) and not TRIPLE.search(core) and not SUSPECT_LETTER.search(core)
                if pairs and not DOUBLES.fullmatch(core):
                    found = word.replace(core, self.undoubled(core), 1)
                else:
                    found = word.replace(core, self.undoubled(self._search(core)), 1)
            self._remember(self.tokens, word, found)
        return found

    def restore(self, text: str, fragments: bool = True) -> str:
        """Lower-case ``text`` with every suspicious span decoded."""
        if fragments:
            text = self.joined(text)
        changed = {w: new for w in set(text.split()) if SUSPECT.search(w) and (new := self.token(w)) != w}
        return TOKEN.sub(lambda m: changed.get(m[0], m[0]), text) if changed else text

    def joined(self, text: str) -> str:
        """Lower-case ``text`` with runs of fragments decoded."""
        text = SPACED.sub(lambda m: self.decode(m[0]), text)
        return FRAGMENTS.sub(lambda m: self.decode(m[0]), text)


@dataclass(frozen=True)
class Suspects:
    """What a fast test finds in lower-case texts; it misses none of the patterns."""

    flags: np.ndarray  # 1 if a text may hold something disguised, 2 if fragments
    whole: str  # all texts, one after the other
    starts: np.ndarray  # places of the texts in it
    tokens: np.ndarray  # text, start and end of each token that may be disguised


def suspects(texts: list[str], kind: np.ndarray) -> Suspects:
    whole = BETWEEN + BETWEEN.join(texts) + 8 * "\n"
    points = _points(whole)
    k = kind[points]
    count = len(points) - 8
    letter, blank, filler = k == 1, k == 0, (k == 3) | (k == 4)
    flags = (k == 2)[:count]
    flags |= filler[:count] & ~blank[1 : count + 1] & np.concatenate([[False], ~blank[: count - 1]])
    flags |= letter[:count] & (points[1 : count + 1] == points[:count])
    # Four fragments of one or two characters in a row.
    edges = np.flatnonzero(np.diff(((k == 1) | (k == 2) | (points >= 0x250)).astype(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    short = ends - begins <= 2
    joined = short[:-1] & short[1:] & (begins[1:] - ends[:-1] <= 3)
    runs = begins[:-3][joined[:-2] & joined[1:-1] & joined[2:]] + 1 if len(joined) > 2 else begins[:0]
    places = np.flatnonzero(flags)
    starts = np.cumsum([0, *[len(t) + len(BETWEEN) for t in texts]])[:-1] + len(BETWEEN)
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    found = np.unique(np.searchsorted(edges, places, side="right") - 1)  # a place is in no blank
    of = np.searchsorted(starts, edges[found], side="right") - 1
    out = np.zeros(len(texts), np.uint8)
    out[of] = 1
    out[np.clip(np.searchsorted(starts, runs, side="right") - 1, 0, len(texts) - 1)] = 2
    return Suspects(out, whole, starts, np.stack([of, edges[found], edges[found + 1]], axis=1))


def suspicious(texts: list[str], kind: np.ndarray) -> np.ndarray:
    """Which lower-case texts may hold something disguised, 2 if fragments."""
    return suspects(texts, kind).flags


def plain(text: str | None) -> str:
    """Lower case; compatibility forms (full-width letters and the like) become plain ones."""
    text = text or ""
    return (text if text.isascii() else unicodedata.normalize("NFKC", text)).lower()


def _restored(texts: list[str | None], decoder: Decoder, kind: np.ndarray) -> list[str]:
    lower = [plain(t) for t in texts]
    if not lower:
        return []
    found = suspects(lower, kind)
    out = list(lower)
    for i in np.flatnonzero(found.flags == 2).tolist():
        lower[i] = decoder.joined(lower[i])
    if any(text is not old for text, old in zip(lower, out, strict=True)):  # some tokens are others now
        found, out = suspects(lower, kind), list(lower)
    changes: dict[int, list[tuple[int, int, str]]] = {}
    for i, start, end in found.tokens.tolist():
        word = found.whole[start:end]
        new = decoder.token(word)
        if new != word:
            changes.setdefault(i, []).append((start, end, new))
    for i, parts in changes.items():
        text, at, first = [], 0, int(found.starts[i])
        for start, end, new in parts:
            text += [lower[i][at : start - first], new]
            at = end - first
        out[i] = "".join([*text, lower[i][at:]])
    return out


def features(text: str) -> set[str]:
    """Words of a restored text, marked by a final blank, and their beginnings."""
    out = set()
    for word in set(WORD.findall(text)):
        if len(word) > 2:
            out.add(f"{word} ")
            out.update(word[:n] for n in PREFIXES if n < len(word))
    return out


@dataclass(frozen=True)
class Model:
    costs: np.ndarray  # of letters
    weights: dict[str, float]  # share of toxic documents among those with the feature
    prior: float  # share of toxic documents
    base: float  # share of toxic documents among those without any


def _feature_counts(costs: np.ndarray, only: frozenset[str] | None):
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder, (_, kind) = Decoder(costs), _classes()
        totals: Counter[str] = Counter()
        for frame in frames:
            for start in range(0, len(frame), 256):
                for text in _restored(frame["text"][start : start + 256].tolist(), decoder, kind):
                    found = features(text)
                    totals.update(found if only is None else found & only)
        if totals:  # an empty column has no kind
            yield pd.DataFrame({"feature": list(totals), "n": list(totals.values())})

    return count


def _above(feature: str) -> list[str]:
    """Shorter beginnings of a word or beginning, the longest first."""
    stem = feature.rstrip(" ")
    return [stem[:n] for n in reversed(PREFIXES) if n < len(feature) and stem[:n] != feature and n <= len(stem)]


def _chosen(a: dict[str, int], b: dict[str, int], toxic: int, clean: int) -> dict[str, float]:
    """Features that toxic texts have more often than chance explains, each with its share of toxic texts.

    ``a`` and ``b`` count toxic and clean texts. Of a beginning and a longer form that nearly all its
    toxic texts have, the longer one counts. A longer form needs a share surely higher than that of the
    beginning it falls under; a beginning must stay significant without the longer forms so taken.
    """
    if not toxic or not clean:
        return {}
    prior = toxic / (toxic + clean)
    needed = 2 * math.log(max(len(a), 1)) + 4  # what chance alone gives to the best of so many features

    def sure(found: int, against: int, usual: float) -> bool:
        share = found / (found + against) if found > 0 else 0.0
        if share < 0.5 or share <= usual:
            return False
        rest = against * math.log((1 - share) / (1 - usual)) if against else 0.0
        return 2 * (found * math.log(share / usual) + rest) > needed

    longer: Counter[str] = Counter()
    for f, n in a.items():
        for stem in _above(f):
            longer[stem] = max(longer[stem], n)
    chosen: dict[str, float] = {}
    under: dict[str, str | None] = {}
    for f in sorted((f for f, n in a.items() if longer[f] < 0.9 * n), key=lambda f: (len(f), f)):
        parent = next((stem for stem in _above(f) if stem in chosen), None)
        usual = chosen[parent] if parent else prior
        if sure(a[f], b.get(f, 0), usual):
            chosen[f], under[f] = (a[f] + prior) / (a[f] + b.get(f, 0) + 1), parent
    for f in sorted(chosen, key=len, reverse=True):
        parts = [g for g, parent in under.items() if parent == f and g in chosen]
        left = a[f] - sum(a[g] for g in parts), b.get(f, 0) - sum(b.get(g, 0) for g in parts)
        if parts and not sure(left[0], max(left[1], 0), prior):
            del chosen[f]
    # A long beginning of a chosen word that no clean text has stands for its other endings.
    for word in [f for f in chosen if f.endswith(" ")]:
        for stem in _above(word):
            if 5 < len(stem) and stem in a and not b.get(stem):
                chosen.setdefault(stem, (a[stem] + prior) / (a[stem] + 1))
    return chosen


def fit(texts: DataFrame, labelled: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on ``labelled`` (doc_id, label); ``texts`` has doc_id and text.

    At most ``fit_rows`` labelled rows, by the hash of their id, are used for the features, a bounded
    sample; the letter model is counted over all texts. Without toxic rows no feature is found.
    """
    costs = letter_model(texts.select("text"))
    some = labelled.orderBy(F.xxhash64("doc_id"), "label").limit(fit_rows)
    rows = staged(texts.join(F.broadcast(some), "doc_id"), "labelled")  # at most fit_rows numbers
    # Copies of a toxic text share all their words, so one text of each group of similar ones counts.
    classes = near_classes(rows.filter("label = 1"), bands=24, rows=1, needed=SIMILAR)
    first = classes.groupBy("class_id").agg(F.min("doc_id").alias("doc_id")).select(F.col("doc_id").cast("string").alias("doc_id"))
    toxic_rows = staged(rows.filter("label = 1").join(first.distinct(), "doc_id", "left_semi").select("text"), "toxic")
    clean_rows = rows.filter("label = 0").select("text")
    toxic, clean = toxic_rows.count(), clean_rows.count()

    def counts(texts: DataFrame, only: frozenset[str] | None) -> DataFrame:
        found = texts.repartition(16).mapInPandas(_feature_counts(costs, only), "feature string, n long")
        return found.groupBy("feature").agg(F.sum("n").alias("n"))

    top = counts(toxic_rows, None).filter("n > 1").orderBy(F.desc("n"), "feature").limit(FIT_FEATURES)
    with_ = {r["feature"]: r["n"] for r in top.collect()}  # at most FIT_FEATURES
    against = {r["feature"]: r["n"] for r in counts(clean_rows, frozenset(with_)).collect()} if with_ else {}
    weights = _chosen(with_, against, toxic, clean)
    prior = toxic / (toxic + clean) if toxic else 0.0
    hits = rows.mapInPandas(_scorer(Model(costs, weights, prior, 0.0), ["label"]), "label int, score double")
    none = hits.filter("score = 0").agg(F.sum("label").alias("t"), F.count(F.lit(1)).alias("n")).first()
    deleted(rows, toxic_rows)
    return Model(costs, weights, prior, ((none["t"] or 0) + 0.05) / (none["n"] + 1))


def _scorer(model: Model, keep: list[str]):
    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        decoder, (_, kind) = Decoder(model.costs, model.weights), _classes()
        machine = ahocorasick.Automaton()
        for stem in {f.rstrip(" ") for f in model.weights}:
            machine.add_word(stem, (len(stem), model.weights.get(f"{stem} ", 0.0), model.weights.get(stem, 0.0)))
        if model.weights:
            machine.make_automaton()

        def judged(text: str) -> float:
            """Evidence of the distinct words: of each, the longest feature it has."""
            if not model.weights:
                return 0.0
            text, words = f" {text} ", {}
            for end, (length, word, prefix) in machine.iter(text):
                start = end - length + 1
                if not text[start - 1].isalpha():
                    share = prefix if text[end + 1].isalpha() else word or prefix
                    if share:  # ends come in order, so longer features replace shorter ones
                        words[WORD.match(text, start)[0]] = share
            if not words:
                return 0.0
            logit = lambda p: math.log(p / (1 - p))
            odds = logit(model.prior) + sum(logit(p) - logit(model.prior) for p in words.values())
            return 1 / (1 + math.exp(-min(odds, 30.0)))

        for frame in frames:
            scores = []
            for start in range(0, len(frame), 256):
                for text in _restored(frame["text"][start : start + 256].tolist(), decoder, kind):
                    scores.append(judged(text) or model.base)
            yield frame[keep].assign(score=scores)

    return score


def _learned(docs: DataFrame, labels: DataFrame, fit_rows: int) -> Model:
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(labels["doc_id"]))
    known = known.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    return fit(rows, known, fit_rows)


def _score_series(model: Model):
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for frame in _scorer(model, [])(pd.DataFrame({"text": batch}) for batch in batches):
            yield frame["score"]

    return score


def toxic_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    ``labels`` has doc_id and toxic; only rows whose crc32(doc_id) leaves another remainder than 1 by 3
    are learned from, the others are held out. Null and empty texts, and all texts if nothing toxic
    was learned, get the share of toxic documents among those without toxic words. Null labels are
    ignored; repeated rows and null ids stay. Other columns are ignored. An empty table gives no rows.
    """
    # Ids travel as text: pandas would turn whole numbers beside nulls into floats.
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = _learned(docs, labels, fit_rows)
    scored = rows.mapInPandas(_scorer(model, ["doc_id"]), "doc_id string, score double")
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def clean_docs(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, with all their columns.

    Learns as ``toxic_scores`` does. Texts are scored where they are read; no row is moved.
    """
    model = _learned(docs, labels, fit_rows)
    score = F.pandas_udf(_score_series(model), "double")
    # Packed, so that no column of the caller can clash with the score.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    judged = docs.select(row, score(text_or_empty(docs["text"])).alias("score"))
    return judged.filter(F.col("score") < threshold).select("row.*")


def held_out(doc_id: Column) -> Column:
    return remainder(doc_id, 3) == 1


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
