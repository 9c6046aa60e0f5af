import numpy as np
import pytest
import xxhash

from tests.llm.helpers import SF, Classes, edge, empty
from tramline.llm import simhash


def plain_print(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - size + 1)
    runs = [b" ".join(words[i : i + size]) for i in range(n)]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def plain(docs, radius=2):
    """(doc_id, fingerprint, component) by comparing every two fingerprints."""
    prints = [plain_print(t) for _, t in docs]
    names = sorted(set(prints))
    classes = Classes(names)
    for i, a in enumerate(names):
        for b in names[:i]:
            if (a ^ b).bit_count() <= radius:
                classes.join(a, b)
    least = {}
    for (doc_id, _), p in zip(docs, prints, strict=True):
        if doc_id is not None:
            root = classes.root(p)
            least[root] = min(least.get(root, doc_id), doc_id)
    return sorted((str(i), f"{p:016x}", str(least.get(classes.root(p)))) for (i, _), p in zip(docs, prints, strict=True))


def found(df):
    return sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in df.collect())


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_query_equals_brute_force(spark):
    docs = rows_of(spark.read.parquet(f"{SF}/documents.parquet"))
    assert found(simhash.op13_simhash_near_dedup(spark, SF)) == plain(docs)


def test_edges_and_empty_table(spark):
    df = edge(spark)
    assert found(simhash.print_classes(df)) == plain(rows_of(df))
    assert simhash.print_classes(empty(spark)).collect() == []


def test_only_ascii_letters_are_lowered_and_only_six_blanks_cut(spark):
    texts = [(1, "ONE Two three"), (2, "one two THREE"), (3, "ÑANDÚ a b"), (4, "ñandú a b"), (5, "one\xa0two three"), (6, "one two\x0bthree\x1f")]
    assert found(simhash.print_classes(spark.createDataFrame(texts, "doc_id long, text string"))) == plain(texts)


def test_longer_texts_than_a_chunk():
    tokens = [b"w%d" % (i % 7919) for i in range(simhash.CHUNK + 1000)]
    assert simhash.fingerprint(tokens) == plain_print(b" ".join(tokens).decode())


@pytest.mark.parametrize("radius,part", [(1, 1 << 16), (2, 1 << 16), (2, 3), (3, 5)])
def test_links_equal_brute_force_with_and_without_split_buckets(spark, radius, part):
    """Dense neighbourhoods, so most block values are shared and cut into several trees."""
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    prints = {0, (1 << 64) - 1}
    for c in centres.tolist():
        for _ in range(30):
            flipped = c
            for bit in rng.integers(0, 64, rng.integers(0, 5)).tolist():
                flipped ^= 1 << bit
            prints.add(flipped)
    names = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in names]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), radius, part).collect()
    got, want = Classes(names), Classes(names)
    for a, b in links:
        got.join(a % (1 << 64), b % (1 << 64))
    for i, a in enumerate(names):
        for b in names[:i]:
            if (a ^ b).bit_count() <= radius:
                want.join(a, b)

    def groups(classes):
        return sorted(sorted(n for n in names if classes.root(n) == r) for r in {classes.root(n) for n in names})

    assert groups(got) == groups(want)
    assert len(links) <= len(names) * (radius + 1) * 8


def test_search_follows_few_edges():
    rng = np.random.default_rng(1)
    items = np.unique(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64))
    tree = np.zeros(len(items), np.int64)
    asked = items[:200] ^ np.uint64(3)
    got = set()
    for who, node in simhash.lookups(items, simhash.grow(items, tree), asked, tree[:200], 2):
        got |= set(zip(who.tolist(), node.tolist(), strict=True))
    want = {(i, j) for i, a in enumerate(asked) for j in np.flatnonzero(np.bitwise_count(items ^ a) <= 2).tolist()}
    assert got == want


def test_chains_are_one_component(spark):
    chain = [0]
    for bit in range(0, 60, 2):
        chain.append(chain[-1] ^ (3 << bit))
    prints = spark.createDataFrame([(p,) for p in chain], "fp long")
    classes = Classes(chain)
    for a, b in simhash.near_links(prints).collect():
        classes.join(a, b)
    assert len({classes.root(p) for p in chain}) == 1
