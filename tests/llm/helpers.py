"""Brute-force counterparts, on rows held in memory."""

import hashlib
from collections import Counter, defaultdict

import duckdb
import numpy as np

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, digest string, row long, kept boolean"

LONG = "lorem ipsum dolor sit amet " * 6000
SAME = "one two three four five six seven eight nine ten"
EDGE = [
    (1, None, None, None, None, 1, "x", 1, True),
    (2, "", "en", "a", 0, 2, "x", 2, False),
    (3, " \n\t ", "en", "a", 4, None, None, None, None),
    (4, SAME, "en", "b", 48, 1, "y", 7, True),
    (5, SAME, "en", "b", 48, 1, "y", 7, True),
    (5, SAME, "en", "b", 48, 1, "y", 7, True),
    (6, SAME + " ", None, "c", 49, 1, "y", 7, True),
    (None, SAME, "en", None, 48, 1, "y", 7, True),
    (None, None, None, None, None, None, None, None, None),
    (7, LONG, "en", "a", len(LONG), 1, "z", 0, None),
    (8, "ñandú 日本 😀 " * 40, "es", "a", 400, 1, "z", 0, None),
    (9, "x" * 50_000, "en", "d", 50_000, 1, "z", 0, None),
]


def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def db(sf_dir=SF):
    con = duckdb.connect()
    for name in ("documents", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows(frame, columns):
    part = frame[columns].astype(object)
    return sorted(map(str, part.where(part.notna(), None).itertuples(index=False, name=None)))


def same_as_sql(query, sql, sf_dir=SF):
    want, got = db(sf_dir).execute(sql).df(), query.toPandas()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    assert rows(want, columns) == rows(got, columns)


class Classes:
    def __init__(self, names):
        self.parent = {n: n for n in names}

    def root(self, n):
        while self.parent[n] != n:
            self.parent[n] = self.parent[self.parent[n]]
            n = self.parent[n]
        return n

    def join(self, a, b):
        self.parent[self.root(a)] = self.root(b)


def shingles(words, size=5):
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def link_similar(sets, classes, needed=8):
    """Joins every two of the sets (by name) with a similarity of ``needed`` tenths."""
    holders = defaultdict(list)
    for name, own in sets.items():
        for other, overlap in Counter(o for s in own for o in holders[s]).items():
            if 10 * overlap >= needed * (len(own) + len(sets[other]) - overlap):
                classes.join(name, other)
        for s in own:
            holders[s].append(name)


def near_classes(docs):
    """Class (smallest id) of each document by its shingles."""
    sets = {i: shingles((t or "").encode().split()) for i, t in docs}
    classes = Classes(sets)
    link_similar(sets, classes)
    first = {}
    for i in sorted(sets):
        first.setdefault(classes.root(i), i)
    return {i: first[classes.root(i)] for i in sets}


def long_repeats(docs, length=50):
    """(doc_id, bytes, removed, spans, sha256 of the rest) by looking up every string."""
    raws, first = [(i, (t or "").encode()) for i, t in docs], {}
    for i, raw in raws:
        for j in range(len(raw) - length + 1):
            key = raw[j : j + length]
            first[key] = min(first.get(key, i), i)
    out = []
    for i, raw in raws:
        gone = np.zeros(len(raw), bool)
        for j in range(len(raw) - length + 1):
            if first[raw[j : j + length]] < i:
                gone[j : j + length] = True
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)
