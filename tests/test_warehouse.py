"""Star tables, lookups, key checks, audit."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tramline.operators import lookup as lookups
from tramline.operators import skew
from tramline.operators.quality import fk_orphans, pk_violations
from tramline.plans import warehouse
from tramline.plans.audit import AuditedRun, audit_rows
from tramline.schemas import (
    BRONZE_TRIP_UPDATE,
    PRIMARY_KEYS,
    STATIC_DIMS,
    STOP_TIMES,
    VEHICLE_POSITION,
    WAREHOUSE,
)
from tramline.sources.tables import read_table, write_table

KEYS = {"start_date": "20240102", "trip_id": "t", "route_id": "r", "stop_id": "s"}
MIDNIGHT = 1704153600  # 2024-01-02 00:00 UTC


def test_dates(spark):
    span = spark.createDataFrame([(date(2024, 1, 7),), (date(2024, 1, 5),)], "d date")
    holidays = spark.createDataFrame([(date(2024, 1, 6),), (date(2024, 1, 6),), (date(2030, 1, 1),)], "date_id date")
    got = warehouse.dim_date(F.min("d"), F.max("d"), span, holidays)
    assert dict(got.dtypes) == WAREHOUSE["dim_date"]
    assert values(got) == [
        (date(2024, 1, 5), 5, False, False),
        (date(2024, 1, 6), 6, True, True),
        (date(2024, 1, 7), 7, True, False),
    ]
    assert warehouse.dim_date(F.min("d"), F.max("d"), span).filter("is_holiday").isEmpty()


def test_stop_delay(rows):
    stopped = KEYS | {"vehicle_id": "v", "current_status": "STOPPED_AT"}
    positions = rows(
        VEHICLE_POSITION,
        stopped | {"vehicle_timestamp": MIDNIGHT + 100, "speed": 0.0},
        stopped | {"vehicle_timestamp": MIDNIGHT + 50, "speed": 4.0},
        stopped | {"vehicle_timestamp": 0, "speed": 2.0},
        KEYS | {"vehicle_id": "v", "vehicle_timestamp": MIDNIGHT + 10, "current_status": "IN_TRANSIT_TO"},
        KEYS | {"vehicle_id": "passing", "vehicle_timestamp": MIDNIGHT, "start_date": "20240102"},
        KEYS | {"vehicle_id": "unplanned", "trip_id": "x"},
        KEYS | {"vehicle_id": "no key", "trip_id": " "},
    )
    updates = rows(
        BRONZE_TRIP_UPDATE,
        KEYS | {"feed_timestamp": 1, "arrival_time": MIDNIGHT + 900},
        KEYS | {"feed_timestamp": 2, "arrival_time": MIDNIGHT + 90},
        KEYS | {"feed_timestamp": 2, "arrival_time": MIDNIGHT + 95},
        KEYS | {"feed_timestamp": 3, "arrival_time": 0},
        KEYS | {"feed_timestamp": 4},
    )
    planned = rows(STOP_TIMES, {"trip_id": "t", "stop_id": "s", "arrival_time": "00:01:00"})
    fact = warehouse.stop_delay(positions, updates, planned, "L")
    assert dict(fact.dtypes) == WAREHOUSE["fact_stop_delay"]
    seconds = [F.unix_seconds(c) - MIDNIGHT for c in ("scheduled_arrival", "estimated_arrival", "actual_arrival")]
    got = values(fact.select("vehicle_id", *seconds, "delay_seconds", "avg_speed_segment", "date_id", "load_number"))
    day = date(2024, 1, 2)
    assert got == [
        ("passing", 60, 95, None, 35, None, day, "L"),
        ("unplanned", None, None, None, None, None, day, "L"),
        ("v", 60, 95, 50, -10, 3.0, day, "L"),
    ]
    assert fact.select("fact_id").distinct().count() == 3
    unscheduled = warehouse.stop_delay(positions, updates, None, "L")
    assert unscheduled.filter("delay_seconds is not null").isEmpty()
    assert values(unscheduled.select("fact_id")) == values(fact.select("fact_id"))  # stable when run again


def test_dim_vehicle_is_unique_with_unsourced_columns_null(rows):
    positions = rows(
        VEHICLE_POSITION,
        KEYS | {"vehicle_id": "v", "license_plate": "old", "vehicle_timestamp": 1},
        KEYS | {"vehicle_id": "v", "license_plate": "new", "vehicle_timestamp": 2},
    )
    dim = warehouse.dim_vehicle(positions, "L", F.timestamp_seconds(F.lit(5)))
    (row,) = dim.collect()
    assert dict(dim.dtypes) == WAREHOUSE["dim_vehicle"]
    assert (row.vehicle_id, row.license_plate, row.vehicle_model, row.load_number) == ("v", "new", None, "L")


@pytest.mark.parametrize("broadcast_rows", [100, 0])
@pytest.mark.parametrize("rows_per_task", [2, 1000])
def test_lookup_by_every_route(spark, broadcast_rows, rows_per_task):
    keys = ["hot"] * 50 + ["warm"] * 2 + ["cold", "unknown"] + [None] * 30 + ["unknown hot"] * 9
    fact = spark.createDataFrame([(key, i) for i, key in enumerate(keys)], "k string, i int")
    dim = spark.createDataFrame([("hot", 1), ("warm", 2), ("cold", 3), (None, 4)], "k string, d int")
    got = lookups.lookup(fact, dim, ["k"], broadcast_rows, rows_per_task)
    assert got.columns == ["k", "i", "d"]
    known = {"hot": 1, "warm": 2, "cold": 3}
    assert {(row.i, row.k, row.d) for row in got.collect()} == {(i, key, known.get(key)) for i, key in enumerate(keys)}
    assert got.count() == len(keys)


def test_lookup_with_a_repeated_hot_dimension_key(spark, monkeypatch):
    fits = lookups.fits_broadcast
    monkeypatch.setattr(lookups, "fits_broadcast", lambda table: fits(table, max_rows=1))
    fact = spark.createDataFrame([("hot", i) for i in range(9)], "k string, i int")
    dim = spark.createDataFrame([("hot", 1), ("hot", 2)], "k string, d int")
    assert lookups.shuffled_lookup(fact, dim, ["k"], rows_per_task=2).count() == 18


def test_hot_keys(spark):
    keys = ["hot"] * 50 + [None] * 30 + ["edge"] * 10 + [f"k{i}" for i in range(500)]
    fact = spark.createDataFrame([(key, 1) for key in keys], "k string, i int")
    assert values(skew.hot_keys(fact, ["k"], 10)) == [(None,), ("hot",)]
    assert skew.hot_keys(fact, ["k"], 50) is None
    assert skew.hot_keys(fact.limit(0), ["k"]) is None


def test_broadcast_size_check(spark):
    table = spark.range(1000).select(F.repeat(F.lit("x"), 100).alias("text"))
    assert lookups.fits_broadcast(table)
    assert not lookups.fits_broadcast(table, max_rows=999)
    assert not lookups.fits_broadcast(table, max_bytes=100_000)
    assert lookups.fits_broadcast(table.limit(0))


def test_key_checks(spark):
    table = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 1)], "k string, n int")
    assert values(pk_violations(table, ["k"])) == [(None, 2), ("a", 2)]
    assert values(pk_violations(table, ["k", "n"])) == [(None, 1, 2)]
    parent = spark.createDataFrame([("b",)], "k string")
    assert values(fk_orphans(table, "k", parent)) == [("a", 2)]


def test_audit_records_success_and_failure(spark, tmp_path):
    def fail(rows):
        raise OSError("disk")

    good, bad = AuditedRun("L", "silver.a"), AuditedRun("L", "silver.b")
    good.write(spark.range(7), lambda rows: write_table(rows, f"{tmp_path}/a"))
    with pytest.raises(OSError):
        bad.write(spark.range(7), fail)
    audit = audit_rows(spark, [good, bad])
    assert dict(audit.dtypes) == WAREHOUSE["audit_pipeline_runs"]
    assert values(audit.select("layer", "status", "row_count")) == [("silver.a", "SUCCESS", 7), ("silver.b", "FAILED", None)]
    assert audit.filter("start_time <= end_time").count() == 2 and audit.select("run_id").distinct().count() == 2


@pytest.fixture
def bronze(rows, tmp_path):
    path = str(tmp_path / "bronze")
    positions = [
        KEYS | {"vehicle_id": f"v{i % 3}", "vehicle_timestamp": MIDNIGHT + i, "current_status": "STOPPED_AT"} for i in range(9)
    ]
    write_table(rows(VEHICLE_POSITION, *positions), f"{path}/vehicle_positions")
    write_table(rows(BRONZE_TRIP_UPDATE, KEYS | {"feed_timestamp": 1, "arrival_time": MIDNIGHT}), f"{path}/trip_updates")
    for name, columns in STATIC_DIMS.items():
        key = {"route": {"route_id": "r"}, "stop": {"stop_id": "s"}, "trip": {"trip_id": "t", "route_id": "gone"}}[name]
        write_table(rows(columns | {"load_number": "string"}, key), f"{path}/dim_{name}")
    return path


def test_whole_warehouse(spark, bronze, tmp_path):
    target = str(tmp_path / "star")
    for load in ("L1", "L2"):
        warehouse.build_warehouse(spark, bronze, target, load)
    tables = {name: read_table(spark, f"{target}/{name}") for name in WAREHOUSE}
    for name, columns in WAREHOUSE.items():
        assert dict(tables[name].dtypes) == columns, name
    counts = {name: tables[name].count() for name in WAREHOUSE}
    assert counts == {
        "dim_route": 1, "dim_stop": 1, "dim_trip": 1, "dim_vehicle": 3, "dim_date": 1, "fact_stop_delay": 3,
        "audit_pipeline_runs": 12,
    }
    assert tables["fact_stop_delay"].select("load_number").distinct().collect() == [("L2",)]
    audit = tables["audit_pipeline_runs"].filter("load_number = 'L2'")
    assert {(r.layer.removeprefix("warehouse."), r.row_count) for r in audit.collect()} == {
        (name, count) for name, count in counts.items() if name != "audit_pipeline_runs"
    }
    broken = {name for name, found in warehouse.key_checks(tables).items() if not found.isEmpty()}
    assert broken == {"dim_trip.route_id"}
    assert set(warehouse.key_checks(tables)) >= {f"{name}.pk" for name in PRIMARY_KEYS}


@pytest.mark.parametrize("kept", [[], [KEYS | {"trip_id": " ", "vehicle_id": "v"}]])
def test_warehouse_without_usable_positions(spark, bronze, rows, tmp_path, kept):
    write_table(rows(VEHICLE_POSITION, *kept), f"{bronze}/vehicle_positions")
    runs = warehouse.build_warehouse(spark, bronze, str(tmp_path / "star"), "L")
    assert {run.status for run in runs} == {"SUCCESS"}
    counts = {run.layer.removeprefix("warehouse."): run.row_count for run in runs}
    assert counts["fact_stop_delay"] == counts["dim_vehicle"] == 0 and counts["dim_route"] == 1


def test_a_save_that_does_nothing_fails_in_time(spark):
    run = AuditedRun("L", "x")
    with pytest.raises(RuntimeError, match="no action"):
        run.write(spark.range(3), lambda rows: None, wait=1.0)
    assert (run.status, run.row_count) == ("FAILED", None) and run.end_time is not None


def test_numbers_too_large_for_the_star_are_null(rows):
    positions = rows(VEHICLE_POSITION, KEYS | {"vehicle_id": "v"}, KEYS | {"vehicle_id": "w", "vehicle_timestamp": 1 << 60, "current_status": "STOPPED_AT"})
    updates = rows(BRONZE_TRIP_UPDATE, KEYS | {"feed_timestamp": 1, "arrival_time": 4102444800}, KEYS | {"feed_timestamp": 2, "arrival_time": 1 << 60})
    plan = rows(STOP_TIMES, {"trip_id": "t", "stop_id": "s", "arrival_time": "00:00:00"})
    got = warehouse.stop_delay(positions, updates, plan, "L").select("vehicle_id", "actual_arrival", "estimated_arrival", "delay_seconds")
    assert sorted((r.vehicle_id, r.actual_arrival, r.delay_seconds) for r in got.collect()) == [("v", None, None), ("w", None, None)]
    assert {r.estimated_arrival.year for r in got.collect()} == {2100}


def test_tables_can_be_saved_elsewhere(spark, bronze, tmp_path):
    saved = {}
    runs = warehouse.build_warehouse(
        spark, bronze, str(tmp_path / "star"), "L", save=lambda rows, table: saved.update({table: rows.count()})
    )
    assert saved == {run.layer.removeprefix("warehouse."): run.row_count for run in runs}
    assert not (tmp_path / "star" / "dim_route").exists()


def test_declared_tables_take_rows(spark, rows):
    warehouse.create_tables(spark, "star")
    try:
        for name, columns in WAREHOUSE.items():
            assert dict(spark.table(f"star.{name}").dtypes) == columns
        dim = warehouse.star_dim(rows(STATIC_DIMS["route"] | {"load_number": "string"}, {"route_id": "r"}), "dim_route")
        warehouse.insert_rows(dim, "star", "dim_route")
        assert isinstance(spark.table("star.dim_route").first().created_at, datetime)
        fact = rows(WAREHOUSE["fact_stop_delay"], {"fact_id": 1, "date_id": date(2024, 1, 2), "load_number": "L"})
        warehouse.insert_rows(fact, "star", "fact_stop_delay")
        (row,) = spark.table("star.fact_stop_delay").collect()
        assert (row.fact_id, row.date_id, row.load_number) == (1, date(2024, 1, 2), "L")
    finally:
        spark.sql("DROP DATABASE star CASCADE")
