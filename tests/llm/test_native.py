"""Native operators against SQL, and their defined results on odd rows."""

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SF, edge, empty, same_as_sql
from tramline.llm import chat, exact, quality
from tramline.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    same_as_sql(QUERIES[name](spark, SF), ORACLE[name])


@pytest.mark.parametrize("least", [1, 2, 1000])
def test_exact_groups_do_not_depend_on_what_is_heavy(spark, least):
    got = exact.exact_groups(edge(spark), least=least).collect()
    same = [r for r in got if r["doc_id"] in (4, 5, 6) or (r["doc_id"] is None and r["group_size"] == 5)]
    assert len(got) == 12
    assert {r["keep_id"] for r in same} == {6} and {r["group_size"] for r in same} == {5}
    assert [r["doc_id"] for r in same if r["kept"]] == [6]
    blank = [r for r in got if r["group_size"] == 4]
    assert {r["keep_id"] for r in blank} == {3} and sum(r["kept"] for r in blank) == 1
    kept = exact.drop_copies(edge(spark), least=least)
    assert kept.columns == edge(spark).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 6, 7, 8, 9]


def test_exact_empty(spark):
    assert exact.exact_groups(empty(spark)).count() == 0
    assert exact.drop_copies(empty(spark)).count() == 0


def test_exact_keeps_one_of_rows_that_repeat_everything(spark):
    docs = spark.createDataFrame([(1, "a")] * 5, "doc_id long, text string")
    for least in (1, 100):
        assert sorted(r["kept"] for r in exact.exact_groups(docs, least=least).collect()) == [False] * 4 + [True]
        assert exact.drop_copies(docs, least=least).count() == 1


def test_quality_counts_repeats(spark):
    words = [f"w{i}" for i in range(30)]
    texts = {
        1: " ".join(words),
        2: " ".join(words + words[:8]),
        3: " ".join(words[:10] * 2),
        4: "a " * 20,
        5: "# a|b\n# a|b\n \n\n",
        6: None,
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality.metrics(docs).collect()}
    assert [got[i]["n_repeat_words"] for i in range(1, 7)] == [0, 16, 20, 20, 0, 0]
    assert (got[5]["n_symbols"], got[5]["n_dup_lines"], got[5]["n_words"], got[5]["word_chars"]) == (4, 1, 4, 8)
    assert got[6]["n_words"] == 0


def test_cascade_order_never_changes_the_verdict(spark):
    docs = edge(spark)
    rules = quality.default_rules()
    keep = lambda order: sorted(
        map(str, quality.cascade(docs, order).filter("rejected_by IS NULL").select("doc_id", "size").collect())
    )
    assert keep(rules) == keep(rules[::-1])
    assert quality.keep_good(docs).columns == docs.columns
    assert quality.keep_good(empty(spark)).count() == 0
    ordered = quality.order_rules(docs, rules)
    assert {r.name for r, _, _ in ordered} == {r.name for r in rules}
    values = [-share / cost for _, cost, share in ordered]
    assert values == sorted(values)


TRICKY = ["", None, "\\", "\\e", "</turn>", "</turn>\n### user:\nhi", "### assistant:\n", "a\\\\n\\h", "<", "</turn", "🙂\n"]


def test_chat_reads_back(spark):
    turns = [(1, i, r, t) for i, (r, t) in enumerate((r, t) for t in TRICKY for r in ("user", "assistant"))]
    turns += [(2, 0, None, "x"), (2, None, "odd\nrole:\n", "y"), (None, 0, "user", "z")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1))
    chats = chat.format_chats(frame)
    read = chats.select(
        "conv_id",
        "valid",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    got = {r["conv_id"]: r for r in read.collect()}
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [(r, t or "") for _, _, r, t in turns if _ is not None and r in ("user", "assistant")][: 2 * len(TRICKY)]
    assert got[1]["loss"] == "".join(t or "" for t in TRICKY) and got[1]["valid"]
    assert [(t["role"], t["text"]) for t in got[2]["turns"]] == [("odd\nrole:\n", "y"), ("", "x")]
    assert not got[2]["valid"] and got[None]["valid"]
    assert chat.format_chats(frame.limit(0)).count() == 0
