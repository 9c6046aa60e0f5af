import hashlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import SF, edge, empty
from tramline.llm import alignment, common

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def sides():
    return alignment.ByteLevel(alignment.default_a()), alignment.Pieces(alignment.default_b())


def plain_groups(a, b, a_ids, b_ids):
    """Groups of ids between the places where a token of either side ends."""

    def ends(side, ids):
        return np.cumsum([len(side.bytes[i]) for i in ids]).tolist()

    both = sorted(set(ends(a, a_ids)) & set(ends(b, b_ids)))
    out, i, j = [], 0, 0
    ea, eb = ends(a, a_ids), ends(b, b_ids)
    for e in both:
        ga, gb = [], []
        while i < len(ea) and ea[i] <= e:
            ga.append(a_ids[i])
            i += 1
        while j < len(eb) and eb[j] <= e:
            gb.append(b_ids[j])
            j += 1
        out.append((ga, gb))
    return out


def plain(sides, docs):
    a, b = sides
    held, counts = [], Counter()
    for doc_id, text in docs:
        groups, links = [], Counter()
        n_a = n_b = 0
        if text:
            raw, a_ids, b_ids = b" " + text.encode(), a.encode([text])[0], b.encode([text])[0]
            spelled = [b"".join(s.bytes[i] for i in ids) for s, ids in ((a, a_ids), (b, b_ids))]
            if spelled == [raw, raw]:
                groups, n_a, n_b = plain_groups(a, b, a_ids, b_ids), len(a_ids), len(b_ids)
        for ga, gb in groups:
            for x in ga:
                for y in gb:
                    links[x, y] += 1
        counts.update(links.keys())
        held.append((doc_id, n_a, n_b, groups, links))
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for doc_id, n_a, n_b, groups, links in held:
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        mark = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        n_best = sum(n for p, n in links.items() if counts[p] == best[p[0]])
        total = sum(n * counts[p] for p, n in links.items())
        out.append((doc_id, n_a, n_b, len(groups), sum(links.values()), n_best, total, mark))
    return sorted(map(str, out)), counts


def found(df):
    return sorted(str(tuple(r[c] for c in COLUMNS)) for r in df.collect())


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_query_equals_brute_force(spark, sides):
    docs = rows_of(spark.read.parquet(f"{SF}/documents.parquet"))
    assert found(alignment.op12_cross_tokenizer_alignment(spark, SF)) == plain(sides, docs)[0]


ODD = [
    (1, "a  b\n\n c"),
    (2, "<|endoftext|> <s> </s> <unk> <0x41>"),
    (3, "a ▁ b"),  # the second side writes a blank for this sign, so its bytes differ
    (4, " lead and tail "),
    (5, "日本語のテキスト ﬁ é é 😀👩‍👩‍👧"),
    (6, "\x00\x01\ttab\r\n"),
    (7, " " * 300 + "x" * 300 + "\n" * 300),
    (8, "ab" * 4000),
    (9, "　wide blank"),
]


def test_odd_texts_small_blocks_and_counts(spark, sides):
    df = spark.createDataFrame(ODD + ODD[:3] + [(None, "a  b")], "doc_id long, text string").repartition(2)
    want, counts = plain(sides, rows_of(df))
    for options in ({}, {"batch_bytes": 1}, {"batch_bytes": 40, "block_pairs": 5}):
        scored, links = alignment.aligned_docs(df, **options)
        assert found(scored) == want
    assert {(r["a"], r["b"]): r["count"] for r in links.collect()} == dict(counts)
    assert "▁" in ODD[2][1] and any(s.startswith("(3, 0, 0, 0, 0, 0, 0, '')") for s in want)


def test_edges_and_empty_table(spark, sides):
    df = edge(spark)
    assert found(alignment.aligned_docs(df)[0]) == plain(sides, rows_of(df))[0]
    scored, links = alignment.aligned_docs(empty(spark))
    assert scored.collect() == [] and links.collect() == []


def test_wide_groups_count_as_link_by_link(sides, monkeypatch):
    a, b = sides
    texts = ["x" * 5000, "日本語" * 50, " " * 1000, "plain words here"]
    lists = a.encode(texts), b.encode(texts)
    usual = list(alignment.Aligned(a, b)(*lists))
    monkeypatch.setattr(alignment, "WIDE", 0)
    for x, y in zip(usual, alignment.Aligned(a, b)(*lists), strict=True):
        assert x[:3] == y[:3] and x[3].tolist() == y[3].tolist() and x[4].tolist() == y[4].tolist()


def test_pointers_lead_to_the_last_token():
    # Ends 2 5 9 and 3 5 7 9: the groups end at 5 and 9.
    label = alignment.terminals(np.array([2, 5, 9]), np.array([3, 5, 7, 9]))
    assert label.tolist() == [1, 1, 2, 1, 1, 2, 2]
    # A chain that alternates to its end: one group.
    label = alignment.terminals(np.arange(2, 2001, 2), np.array([*range(1, 2000, 2), 2000]))
    assert set(label.tolist()) == {999}


def test_a_million_blanks_letters_and_line_ends(spark, sides):
    texts = [(i, c * 1_000_000) for i, c in enumerate((" ", "\n", "a"))]
    got = alignment.aligned_docs(spark.createDataFrame(texts, "doc_id long, text string"))[0].collect()
    assert len(got) == 3 and all(r["n_groups"] > 0 for r in got)


MIX = st.text(st.sampled_from(" \t\n\r'sdmtrevlABz09é²ªß·×ſɏ-.,<|>_\xa0\x85\x1c▁日😀"), max_size=60)


@settings(max_examples=400, deadline=None)
@given(st.lists(MIX, max_size=4))
def test_ids_of_words_are_the_tokenizers_own(texts):
    a = ids_side()
    whole = a.tokenizer.encode_batch([" " + t for t in texts], add_special_tokens=False)
    assert a.encode(texts) == [e.ids for e in whole]


def ids_side(kept=[]):
    if not kept:
        kept.append(alignment.ByteLevel(alignment.default_a()))
    return kept[0]


def test_ids_of_whole_texts_and_a_small_memory(monkeypatch):
    import pyarrow.parquet as pq

    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()]
    a = ids_side()
    whole = a.tokenizer.encode_batch([" " + t for t in texts], add_special_tokens=False)
    assert a.encode(texts) == [e.ids for e in whole]
    monkeypatch.setattr(alignment, "KNOWN_WORDS", 50)
    assert a.encode(texts[:50]) == [e.ids for e in whole[:50]]
    assert len(a.known) < 100_000


def test_words_in_use_are_taken_over_and_unspelled_ones_end_a_text():
    merged = []

    def merge(word):
        merged.append(word)
        if word == "bad":
            raise alignment.Unspelled
        return [len(word)]

    known = alignment.Known(merge, {"old": [7], "unused": [8]})
    assert [known[w] for w in ("old", "word", "old", "word")] == [[7], [4], [7], [4]]
    assert merged == ["word"] and dict(known) == {"old": [7], "word": [4]} and known.letters == 7
    with pytest.raises(alignment.Unspelled):
        known["bad"]
    assert "bad" not in known and known.letters == 7


def test_blocks_do_not_search_remembered_words_for_cycles(monkeypatch):
    """After three of four blocks only what is new since the last ones is searched, after the fourth all."""
    searched = []
    monkeypatch.setattr(alignment.gc, "collect", lambda generation=2: searched.append(generation) or 0)
    monkeypatch.setattr(alignment.TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda self: 0})()))
    frame = pd.DataFrame({"doc_id": [str(i) for i in range(40)], "text": [f"some words and {i} more of them" for i in range(40)]})
    made = list(alignment._blocks(None, None, 64, 16)(iter([frame])))
    assert sum(len(b["doc_id"].iloc[0]) for b in made) == 40
    assert len(searched) > 8 and searched == [2 if i % alignment.SEARCHED == 0 else 1 for i in range(1, len(searched) + 1)]


def test_a_block_travels_small(sides):
    """Steps and counts of links are small numbers; a row is sorted and handed on whole, so it must not take eight bytes for each."""
    rng = np.random.default_rng(7)
    none = np.zeros(0, np.int64)
    own = [np.sort(rng.choice(20_000, int(n), replace=False)) for n in rng.integers(0, 700, 200)]
    docs = [(str(i), 1, 1, 1, 1, "", c, rng.integers(1, 9, len(c))) for i, c in enumerate(own)] + [("x", 0, 0, 0, 0, "", none, none)]
    row = alignment._block(3, docs).iloc[0]
    links = int(row["held"].sum())
    assert len(row["steps"]) + len(row["times"]) < 4 * links
    assert alignment._unplaned(row["times"], links).tolist() == np.concatenate([d[-1] for d in docs]).tolist()
    for values in ([], [0], [0, 0], [255, 256], [1 << 40, 0, 7], [(1 << 63) - 1, 1]):
        assert alignment._unplaned(alignment._planes(np.array(values, np.int64)), len(values)).tolist() == values


def test_few_texts_are_handed_over_at_once(spark, monkeypatch):
    seen = {}
    staged = alignment.staged
    monkeypatch.setattr(alignment, "staged", lambda df, name: seen.update({name: spark.conf.get(common.BATCH, None)}) or staged(df, name))
    before = spark.conf.get(common.BATCH, None)
    assert alignment.aligned_docs(spark.createDataFrame([(1, "a few words")], "doc_id long, text string"))[0].count() == 1
    assert int(seen["blocks"]) <= 500 and spark.conf.get(common.BATCH, None) == before


def test_tokenizers_are_read_once(spark, sides, monkeypatch):
    """Of a worker's tasks none reads the tokenizers anew: those of tasks before are cycles and stay until these are found."""
    read = []
    own = alignment.ByteLevel.__init__
    monkeypatch.setattr(alignment.ByteLevel, "__init__", lambda self, path: read.append(path) or own(self, path))
    monkeypatch.setattr(alignment.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 2})())
    docs = [(str(i), f"word{i} and some more words") for i in range(6)]
    make = alignment._blocks(None, None, 1 << 18, 1 << 18)
    found = [pd.concat(make(iter([pd.DataFrame(docs, columns=["doc_id", "text"])]))) for _ in range(5)]
    assert len(read) <= 1
    assert len({str(f.drop(columns=["pairs", "docs"]).to_dict("records")) for f in found}) == 1
