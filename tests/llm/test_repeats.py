"""Near copies, repeated paragraphs and long repeats against brute force."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.llm import helpers
from tests.llm.helpers import SF, edge, empty
from tramline.llm import common, graph, near, paragraphs, repeats


@pytest.fixture(scope="module")
def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def chain(copies, words=60):
    """A text, and copies that each change one word of the one before."""
    rng = np.random.default_rng(5)
    text = [f"w{i}" for i in rng.integers(0, 10**6, words)]
    out = [(0, " ".join(text))]
    for i in range(1, copies):
        text[int(rng.integers(0, words))] = f"new{i}"
        out.append((i, " ".join(text)))
    return out


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (5, 5), (None, 3), (100, 101)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_that_are_found_take_no_more_passes(spark, monkeypatch):
    """Stars are written once, not once more to see that nothing changes."""
    written = []
    monkeypatch.setattr(graph, "staged", lambda df, name: written.append(name) or common.staged(df, name))
    stars = [(1, i) for i in range(2, 50)] + [(50, i) for i in range(51, 60)]
    got = {tuple(r) for r in graph.components(spark.createDataFrame(stars, "a long, b long")).collect()}
    assert got == {(i, 1) for i in range(1, 50)} | {(i, 50) for i in range(50, 60)} and len(written) == 1
    met = graph.components(spark.createDataFrame([*stars, (50, 2)], "a long, b long"))
    assert {tuple(r) for r in met.collect()} == {(i, 1) for i in range(1, 60)} and len(written) <= 5


def test_components_of_any_graph(spark):
    rng = np.random.default_rng(5)
    edges = [tuple(map(int, e)) for e in rng.integers(0, 400, (330, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(2000 - i, 2100) for i in range(40)]
    classes = helpers.Classes({i for e in edges for i in e if e[0] != e[1]})
    for a, b in edges:
        if a != b:
            classes.join(a, b)
    least = {}
    for i in sorted(classes.parent):
        least.setdefault(classes.root(i), i)
    got = [tuple(r) for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()]
    assert sorted(got) == sorted((i, least[classes.root(i)]) for i in classes.parent)


def test_sketch_estimates_probability_jaccard():
    rng = np.random.default_rng(0)
    shared, own = rng.integers(0, 2**63, 300).astype(np.uint64), rng.integers(0, 2**63, 200).astype(np.uint64)
    a = dict(zip(shared, rng.random(300) * 5, strict=True)) | dict(zip(own[:100], rng.random(100), strict=True))
    b = {k: a[k] for k in shared} | dict(zip(own[100:], rng.random(100) * 3, strict=True))
    want = sum(1 / sum(max(a.get(y, 0) / a[x], b.get(y, 0) / b[x]) for y in a | b) for x in shared)
    keys = np.array([*a, *b], np.uint64)
    sketch = near.prob_min_hash(np.repeat([0, 1], 400), keys, np.array([*a.values(), *b.values()]), 2, 8000)
    assert abs((sketch[0] == sketch[1]).mean() - want) < 0.02


def test_near_classes_equal_brute_force(spark, documents):
    docs = documents + [(i + 10_000, t) for i, t in chain(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near.near_classes(frame).collect()}
    assert got == helpers.near_classes(docs)
    kept = near.keep_one(frame)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(got.values()))


def test_near_edges(spark):
    got = near.near_classes(edge(spark)).collect()
    assert len(got) == 12
    assert {r["class_id"] for r in got if r["doc_id"] in (4, 5, 6)} == {4}
    assert {r["class_id"] for r in got if r["doc_id"] in (1, 2, 3)} == {1}
    kept = near.keep_one(edge(spark))
    assert kept.columns == edge(spark).columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 7, 8, 9]
    assert near.near_classes(empty(spark)).count() == 0 and near.keep_one(empty(spark)).count() == 0


def test_paragraphs_equal_brute_force(spark, documents):
    rows = [(i, p, b" ".join(w)) for i, t in documents for p, w in paragraphs._parts(t, 8)]
    sets = {u: helpers.shingles(u.split()) for _, _, u in rows}
    classes = helpers.Classes(sets)
    helpers.link_similar(sets, classes)
    first = {}
    for i, p, u in sorted(rows):
        first.setdefault(classes.root(u), (i, p))
    want = sorted((i, p) for i, p, u in rows if first[classes.root(u)] != (i, p))
    names, removed = paragraphs.repeated_paragraphs(spark.createDataFrame(documents, "doc_id long, text string"))
    got = removed.join(names.select("row", "doc_id"), "row").select("doc_id", "place").collect()
    assert sorted(map(tuple, got)) == want


def test_paragraphs_leave_the_rest(spark):
    docs = [(1, "a b c d e f g h. short. i j k l m n o p\nq"), (2, "z a b c d e f g h."), (3, "x. a b c d e f g h. y"), (None, None)]
    got = {r["doc_id"]: r["text"] for r in paragraphs.without_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: docs[0][1], 2: "", 3: "x. y", None: ""}
    assert paragraphs.without_repeats(edge(spark)).count() == 12
    assert paragraphs.without_repeats(empty(spark)).count() == 0


def test_long_repeats_equal_brute_force(spark, documents):
    passage = "ein langer Absatz, der überall steht und sich immer gleich liest; " * 2
    docs = documents + [(20_000 + i, f"{'x' * i} {passage[: 40 + 7 * i]}{i}") for i in range(12)] + [(30_000, "ab" * 400), (30_001, "ba" * 30)]
    got = repeats.without_long_repeats(spark.createDataFrame(docs, "doc_id long, text string"), with_bytes=True).collect()
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(tuple(r[c] for c in columns) for r in got) == helpers.long_repeats(docs)
    assert all(len(r["kept"]) == r["n_bytes"] - r["n_removed"] for r in got)


def test_long_repeats_edges(spark):
    got = repeats.without_long_repeats(edge(spark)).collect()
    assert len(got) == 12
    by = {(r["doc_id"], r["n_bytes"]): r["n_removed"] for r in got}
    assert by[(9, 50_000)] == 0 and by[(5, 48)] == 0
    assert repeats.without_long_repeats(empty(spark)).count() == 0


def test_index_keeps_runs_only():
    strings = [b"abcabcabcabc" * 5] * 40
    index, _ = repeats.build(strings, np.arange(40))
    assert len(index.starts) < 300 < 40 * 61
    assert all((h == 0).all() for h in repeats.first_holders(strings, np.arange(40)))


def test_many_copies_are_settled_alike(spark):
    docs = [(i, "the same text of more than fifty bytes, again and again and again") for i in range(100)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("length", F.lit("x"))
    got = repeats.without_long_repeats(frame).orderBy("doc_id").collect()
    assert [r["n_removed"] for r in got] == [0] + [65] * 99


def test_every_holder_is_linked(spark):
    p, q = "one two three four five six seven eight nine.", "red green blue black white pink grey brown gold."
    docs = [(5, p), (12, q), (30, f"{p} {q}"), (31, "nothing of this is anywhere else in the table")]
    found = paragraphs.repeated_paragraphs(spark.createDataFrame(docs, "doc_id long, text string"))
    got = {r["doc_id"]: [(x["first_id"], x["words"]) for x in r["linked"]] for r in paragraphs.linked_docs(*found).collect()}
    assert got == {5: [], 12: [], 30: [(5, 9), (12, 9)], 31: []}


def test_large_anchors_are_not_indexed_together(spark):
    """One gram in ever new surroundings: no group indexes all its pieces, and the result is the same."""
    rng = np.random.default_rng(3)
    passage = "this sentence stands in very many of the texts"
    around = ["".join(map(chr, rng.integers(97, 123, 30))) for _ in range(120)]
    docs = [(i, f"{around[i]} {passage} {around[(i * 7) % 60]}") for i in range(120)]
    docs += [(200 + i, f"{around[i]} {passage}, and more") for i in range(20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    got = repeats.without_long_repeats(frame, anchor_bytes=500).collect()
    assert sorted(tuple(r[c] for c in columns) for r in got) == helpers.long_repeats(docs)
    assert any(r["n_removed"] for r in got)


def test_staged_tables_leave_no_shuffle_files(spark):
    from tramline.llm.common import CLEAN_UP, deleted, staged

    root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f for f in root.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}

    before = files()
    table = staged(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert not files() - before
    assert spark.conf.get(CLEAN_UP, None) != "true" and table.count() == 7
    deleted(table)
    assert table.inputFiles() and not any(os.path.exists(f.removeprefix("file://")) for f in table.inputFiles())


def test_ranks_need_few_sorts(monkeypatch):
    text = np.frombuffer(b"abab" * 20 + b"\xff" + b"abababab" * 30 + b"\xff", np.uint8)
    calls, dense = [], repeats._dense
    monkeypatch.setattr(repeats, "_dense", lambda keys, width: calls.append(width) or dense(keys, width))
    rank, half = repeats._ranks(text)
    suffixes = [bytes(text[i:]) for i in range(len(text))]
    order = sorted(set(suffixes))
    assert rank.tolist() == [order.index(x) for x in suffixes]
    short = sorted({x[:32] for x in suffixes})
    assert half.tolist() == [short.index(x[:32]) for x in suffixes]
    assert len(calls) <= 8
    keys = np.array([5, 3, 5, 1 << 60], np.uint64)
    assert [dense(keys, width)[0].tolist() for width in (61, 64)] == [[1, 0, 1, 2]] * 2


def test_no_texts_lie_beside_their_pieces(spark, monkeypatch):
    """While anchors are indexed, of all tables written before only facts, heavy and hot ones and the pieces are left."""
    written, left = {}, []

    def kept(df, name):
        written[name] = common.staged(df, name)
        return written[name]

    def ranges(cuts, anchor_bytes, own=repeats._ranges):
        files = {name: df.inputFiles() for name, df in written.items() if name in ("facts", "heavy", "hot", "shared", "cuts")}
        left.append({name for name, names in files.items() if any(os.path.exists("/" + f.removeprefix("file:").lstrip("/")) for f in names)})
        return own(cuts, anchor_bytes)

    monkeypatch.setattr(repeats, "staged", kept)
    monkeypatch.setattr(repeats, "_ranges", ranges)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = repeats.without_long_repeats(docs).collect()
    assert left == [{"facts", "heavy", "hot", "cuts"}] * repeats.PARTS
    want = helpers.long_repeats([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(tuple(r) for r in got) == want


def test_anchors_of_many_texts_are_shared_by_all(spark):
    """Anchors that the sample finds hot, also of document 0, and anchors of one document alone."""
    rng = np.random.default_rng(9)
    words = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 10**9, n))
    common_text = words(40)
    docs = [(i, f"{words(12)} {common_text} {words(12)}") for i in range(3000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in repeats.without_long_repeats(frame).collect()}
    assert got[0] == 0 and all(got[i] >= len(common_text) for i in range(1, 3000)) and len(got) == 3000


def test_only_tied_suffixes_are_sorted_again(monkeypatch):
    """One long run of a letter among other text: its doublings do not sort the rest again."""
    rng = np.random.default_rng(2)
    text = np.concatenate([rng.integers(97, 123, 20_000), np.full(2_000, 98), [255]]).astype(np.uint8)
    keys = []
    for name in ("sort", "argsort"):
        own = getattr(np, name)
        monkeypatch.setattr(repeats.np, name, lambda x, *a, own=own, **b: keys.append(len(x)) or own(x, *a, **b))
    rank, half = repeats._ranks(text)
    monkeypatch.undo()
    raw = text.tobytes()
    assert np.argsort(rank).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    short = sorted({raw[i : i + 32] for i in range(len(raw))})
    assert [short[r] for r in half.tolist()] == [raw[i : i + 32] for i in range(len(raw))]
    assert sum(keys) < 3 * len(text)


def test_ranks_at_the_end_of_the_text():
    """Texts that end in letters smaller than all others, and noughts before the end."""
    rng = np.random.default_rng(4)
    for letters in (1, 2, 4):
        for _ in range(40):
            text = rng.integers(0, letters, int(rng.integers(1, 200))).astype(np.uint8)
            text[rng.random(len(text)) < 0.1] = 255
            rank, half = repeats._ranks(text)
            raw = text.tobytes()
            order, short = sorted(raw[i:] for i in range(len(raw))), sorted({raw[i : i + 32] for i in range(len(raw))})
            assert [order[r] for r in rank.tolist()] == [raw[i:] for i in range(len(raw))]
            assert [short[r] for r in half.tolist()] == [raw[i : i + 32] for i in range(len(raw))]


def test_long_strings_go_back_as_short_ones_do(monkeypatch):
    rng = np.random.default_rng(6)
    strings = [bytes(rng.integers(97, 99, int(n)).astype(np.uint8)) for n in (*rng.integers(0, 90, 40), 700, 650, 49, 50)]
    strings += [strings[-4][100:400], strings[-3]]
    docs, holder = rng.permutation(len(strings)), {}
    for doc, s in zip(docs.tolist(), strings, strict=True):
        for i in range(len(s) - repeats.LENGTH + 1):
            holder[s[i : i + repeats.LENGTH]] = min(doc, holder.get(s[i : i + repeats.LENGTH], doc))
    want = [[holder[s[i : i + repeats.LENGTH]] for i in range(len(s) - repeats.LENGTH + 1)] for s in strings]
    for few in (0, 1, 8, 1000):
        monkeypatch.setattr(repeats, "FEW", few)
        assert [x.tolist() for x in repeats.first_holders(strings, docs)] == want


def test_texts_hashed_together_have_their_own_pieces():
    rng = np.random.default_rng(8)
    raws = [bytes(rng.integers(97, 100, int(n)).astype(np.uint8)) for n in (0, 300, 49, 50, 51, 0, 24, 500, 1)]
    raws.append(raws[7][20:300])
    anchors, starts, lengths, of = repeats.pieces_of(raws)
    alone = [(a, s, n, i) for i, raw in enumerate(raws) for a, s, n in zip(*(x.tolist() for x in repeats.pieces(raw)), strict=True)]
    assert list(zip(anchors.tolist(), starts.tolist(), lengths.tolist(), of.tolist(), strict=True)) == alone
    by_string = {}  # a string has one anchor wherever it is
    for a, s, n, i in alone:
        for at in range(s, s + n - repeats.LENGTH + 1):
            assert by_string.setdefault(raws[i][at : at + repeats.LENGTH], a) == a
    assert sum(n - repeats.LENGTH + 1 for n in lengths.tolist()) == sum(max(len(r) - repeats.LENGTH + 1, 0) for r in raws)


def test_anchors_travel_as_arrays():
    """What is dealt out is a row per task and cell; anchors with no company or in one text alone give nothing."""
    rng = np.random.default_rng(10)
    texts = ["".join(map(chr, rng.integers(97, 123, 4_000))) for _ in range(300)]
    texts = [t + texts[(i * 7) % 50][100:300] for i, t in enumerate(texts)]
    frame = pd.DataFrame({"name": np.arange(300), "text": texts})
    found = [(a, i) for i, t in enumerate(texts) for a in set(repeats.pieces(t.encode())[0].tolist())]
    names = {}
    for a, i in found:
        names.setdefault(a, set()).add(i)
    hot = np.sort(np.array([a for a, own in names.items() if len(own) > 5], np.int64))
    dealt = pd.concat(repeats._dealt(7, hot)(iter([frame.iloc[:100], frame.iloc[100:]])))
    assert len(dealt) <= 7 * (1 + len(found) // (7 << 14))
    met = pd.concat([repeats._met(5)(g) for _, g in dealt.groupby("cell")])
    shared = pd.concat([repeats._by_name(g) for _, g in met.groupby("cell")])
    want = {(i, a) for a, own in names.items() if len(own) > 1 and a not in set(hot.tolist()) for i in own}
    assert {(n, a) for n, own in zip(shared["name"], shared["shared"], strict=True) for a in own.tolist()} == want
    assert shared["name"].is_unique and want


def test_rows_given_many_times_have_their_spans_once(spark, monkeypatch):
    """Spans travel as one number each, and those of equal rows are not kept for every one of them."""
    rng = np.random.default_rng(12)
    passage, other = ("".join(map(chr, rng.integers(97, 123, 120))) for _ in range(2))
    docs = [(1, f"{passage} first"), *[(2, f"ä {passage} and {passage}")] * 30, (3, f"{other} {passage[:70]} ü {other}"), (9, other)]
    spans = []

    def kept(df, name):
        out = common.staged(df, name)
        if name == "ranges" and "spans" in out.columns:
            assert dict(out.dtypes)["spans"] == "array<bigint>"
            spans.extend(len(r["spans"]) for r in out.collect())
        return out

    monkeypatch.setattr(repeats, "staged", kept)
    got = repeats.without_long_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted((str(tuple(r[c] for c in columns)) for r in got)) == sorted(map(str, helpers.long_repeats(docs)))
    assert len(spans) == 3 and max(spans) <= 2 * 2 * 120


def test_a_large_group_is_indexed_in_bounded_memory():
    """One anchor's pieces, 4 MB of them: an index of as many as are allowed must leave a worker room."""
    import tracemalloc

    rng = np.random.default_rng(14)
    passage, noise = b"this sentence stands in very many of the texts. ", rng.integers(97, 123, (55_000, 28)).astype(np.uint8)
    strings = [passage + n.tobytes() for n in noise]
    tracemalloc.start()
    try:
        holders = repeats.first_holders(strings, np.arange(len(strings)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 55 * sum(map(len, strings)) and len(holders) == len(strings)
    assert all(h[0] == i or noise[h[0]][:2].tobytes() == noise[i][:2].tobytes() for i, h in enumerate(holders[:2000]))
