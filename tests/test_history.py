"""Dimensions with history."""

import os
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tramline.operators.history import STAMPS, as_of, merge_history, row_hash, unique_rows
from tramline.plans.dimensions import DimensionTable
from tramline.schemas import WAREHOUSE, ddl
from tramline.sources.commits import CommitLog

COLUMNS = {"a": "string", "b": "int", "x": "double", "t": "string"}
NEVER = {**COLUMNS, **STAMPS}


def second(n):
    return F.timestamp_seconds(F.lit(n))


def stamp(n):
    return None if n is None else datetime.fromtimestamp(n, timezone.utc).replace(tzinfo=None)


def plain(loads, complete):
    """Rows by walking the loads, keys (a, b)."""
    rows, first, now = [], {}, {}
    for n, load in enumerate(loads, 1):
        for key, value in load.items():
            first.setdefault(key, n)
            if key in now and now[key][0] == value:
                continue
            if key in now:
                rows.append((*key, *now[key][0], first[key], now[key][1], n))
            now[key] = (value, n)
        for key in [k for k in now if k not in load]:
            if complete:
                rows.append((*key, *now[key][0], first[key], now[key][1], n))
                del now[key]
    rows += [(*key, *value, first[key], n, None) for key, (value, n) in now.items()]
    return sorted(map(str, rows))


@pytest.mark.parametrize("complete", [True, False])
def test_many_loads_equal_a_walk(spark, complete):
    rng = random.Random(2)
    texts = [None, "", "x", "y"]
    loads = []
    for _ in range(5):
        keys = [(a, b) for a in ("k", "l", "") for b in range(6) if rng.random() < 0.7]
        loads.append({k: (rng.choice([None, 1.5, 2.5]), rng.choice(texts)) for k in keys})
    loads.append({})
    loads.append(loads[0])
    history = spark.createDataFrame([], ddl(NEVER))
    for n, load in enumerate(loads, 1):
        incoming = spark.createDataFrame([(*k, *v) for k, v in load.items()], ddl(COLUMNS))
        history = merge_history(history, incoming, ["a", "b"], second(n), f"L{n}", complete).checkpoint()
    seconds = [F.unix_seconds(c) for c in ("created_at", "valid_from", "valid_to")]
    got = sorted(str(tuple(r)) for r in history.select(*COLUMNS, *seconds).collect())
    assert got == plain(loads, complete)
    assert history.filter("updated_at <> valid_from").isEmpty()
    for n, load in enumerate(loads, 1):
        if complete:
            assert as_of(history, second(n)).count() == len(load)


def test_rows_without_identity_and_repeated_keys(spark):
    rows = spark.createDataFrame([("k", 1, 1.0, "x"), ("k", 1, 1.0, "y"), (None, 1, 1.0, "x"), ("k", None, 0.0, "")], ddl(COLUMNS))
    assert values(unique_rows(rows, ["a", "b"])) == [("k", 1, 1.0, "y")]
    assert values(unique_rows(rows.select("a"), ["a"])) == [("k",)]


def test_a_null_is_not_an_empty_text_nor_its_neighbour(spark):
    rows = spark.createDataFrame([(None, "x"), ("x", None), ("", "x"), ("x", ""), (None, None)], "a string, b string")
    assert rows.select(row_hash(["a", "b"])).distinct().count() == 5


@pytest.fixture
def dim(spark, tmp_path):
    return DimensionTable(spark, str(tmp_path), "dim_vehicle")


def plates(spark, **by_id):
    return spark.createDataFrame(list(by_id.items()), "vehicle_id string, license_plate string")


def test_versions(spark, dim):
    assert dim.current().collect() == []
    assert dim.merge(plates(spark, v="P", w="Q"), "L1", second(1), complete=False)
    assert dim.merge(plates(spark, v="R", u=None), "L2", second(2), complete=False)
    assert dict(dim.current().dtypes) == WAREHOUSE["dim_vehicle"]
    got = values(dim.current().select("vehicle_id", "license_plate", "created_at", "updated_at", "load_number"))
    one, two = (row[2] for row in (got[2], got[0]))
    assert [r[:2] + r[4:] for r in got] == [("u", None, "L2"), ("v", "R", "L2"), ("w", "Q", "L1")]
    assert [r[2:4] for r in got] == [(two, two), (one, two), (one, one)] and one < two
    assert not dim.merge(plates(spark), "L2", second(9))
    assert dim.history().count() == 4
    versions = os.listdir(f"{dim.path}/data")
    assert len(versions) == 2 and len(dim.drop_versions()) == 1 and dim.drop_versions() == []
    assert dim.history().count() == 4


def test_a_broken_merge_changes_nothing(spark, dim, monkeypatch):
    dim.merge(plates(spark, v="P"), "L1", second(1))
    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", lambda *args, **options: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            dim.merge(plates(spark, v="R"), "L2", second(2))
    assert values(dim.current().select("license_plate")) == [("P",)]
    assert dim.merge(plates(spark, v="R"), "L2", second(2))
    assert dim.history().count() == 2
