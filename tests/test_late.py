"""Facts before their dimension rows."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tramline.operators import lookup as lookups
from tramline.plans.dimensions import DimensionTable
from tramline.plans.late import HeldFacts, infer_members, with_missing
from tramline.schemas import WAREHOUSE
from tramline.sources.commits import CommitLog


@pytest.fixture
def facts(rows):
    def build(*pairs):
        return rows(WAREHOUSE["fact_stop_delay"], *[{"trip_id": t, "stop_id": s, "fact_id": i} for i, (t, s) in enumerate(pairs)])

    return build


def dims(spark, trips, stops):
    return {
        "dim_trip": spark.createDataFrame([(t,) for t in trips], "trip_id string"),
        "dim_stop": spark.createDataFrame([(s,) for s in stops], "stop_id string"),
        "dim_unrelated": spark.createDataFrame([], "x int"),
    }


def passed(held):
    return values(held.passed().select("trip_id", "stop_id", "passed_in"))


def waits(held):
    return values(held.held().select("trip_id", "stop_id", "missing", "held_since"))


@pytest.mark.parametrize("broadcast_rows", [None, 0])
def test_missing_parents_are_named(spark, facts, monkeypatch, broadcast_rows):
    if broadcast_rows is not None:
        fits = lookups.fits_broadcast
        monkeypatch.setattr(lookups, "fits_broadcast", lambda table, *_: fits(table, max_rows=0))
    rows = facts(("t", "s"), ("t", "x"), ("y", "x"), (None, "s"), (None, None), *[("y", "s")] * 20)
    parents = {"trip_id": spark.createDataFrame([("t",), ("t",), (None,)], "trip_id string"), "stop_id": spark.createDataFrame([("s",)], "stop_id string")}
    got = values(with_missing(rows, parents).groupBy("trip_id", "stop_id", "missing").count())
    assert got == [
        (None, None, [], 1), (None, "s", [], 1), ("t", "s", [], 1), ("t", "x", ["stop_id"], 1),
        ("y", "s", ["trip_id"], 20), ("y", "x", ["trip_id", "stop_id"], 1),
    ]
    assert with_missing(rows, {}).filter("size(missing) > 0").isEmpty()


def test_rows_pass_when_their_last_parent_comes(spark, facts, tmp_path):
    held = HeldFacts(spark, str(tmp_path))
    assert passed(held) == [] and waits(held) == []
    assert held.load(facts(("t", "s"), ("u", "x"), ("u", "x")), dims(spark, "t", "s"), "L1")
    assert passed(held) == [("t", "s", "L1")]
    assert waits(held) == [("u", "x", ["trip_id", "stop_id"], "L1")] * 2
    assert held.load(facts(("v", "s")), dims(spark, "tu", "s"), "L2")
    assert waits(held) == [("u", "x", ["stop_id"], "L1")] * 2 + [("v", "s", ["trip_id"], "L2")]
    assert not held.load(facts(("t", "s")), dims(spark, "tuv", "sx"), "L2")
    assert held.load(facts(), dims(spark, "tuv", "sx"), "L3")
    assert waits(held) == []
    assert passed(held) == [("t", "s", "L1"), ("u", "x", "L3"), ("u", "x", "L3"), ("v", "s", "L3")]


def test_a_broken_load_takes_nothing(spark, facts, tmp_path, monkeypatch):
    held = HeldFacts(spark, str(tmp_path))
    held.load(facts(("u", "s")), dims(spark, "t", "s"), "L1")
    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", lambda *args, **options: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            held.load(facts(("t", "s")), dims(spark, "tu", "s"), "L2")
    assert passed(held) == [] and len(waits(held)) == 1
    held.load(facts(("t", "s")), dims(spark, "tu", "s"), "L2")
    assert passed(held) == [("t", "s", "L2"), ("u", "s", "L2")] and waits(held) == []


def test_inferred_members_keep_their_first_stamp(spark, facts, tmp_path):
    dim = DimensionTable(spark, str(tmp_path), "dim_stop")
    dim.merge(spark.createDataFrame([("s", "known")], "stop_id string, stop_name string"), "L1", F.timestamp_seconds(F.lit(1)))
    rows = facts(("t", "s"), ("t", "x"), ("t", "x"), ("t", None))
    assert infer_members(dim, rows, "L1", F.timestamp_seconds(F.lit(2)))
    assert values(dim.current().select("stop_id", "stop_name")) == [("s", "known"), ("x", None)]
    assert not infer_members(dim, rows, "L1")
    both = [("s", "known"), ("x", "late")]
    dim.merge(spark.createDataFrame(both, "stop_id string, stop_name string"), "L2", F.timestamp_seconds(F.lit(3)))
    got = dim.current().select("stop_id", "stop_name", F.unix_seconds("created_at"), "load_number")
    assert values(got) == [("s", "known", 1, "L1"), ("x", "late", 2, "L2")]
