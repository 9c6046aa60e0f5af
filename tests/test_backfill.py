"""The batch fact by day: days are replaced, never doubled."""

import os
from datetime import date, datetime

import pytest

from tests.conftest import values
from tramline.plans.fact import DayTable, append_fact, backfill_fact
from tramline.schemas import BRONZE_TRIP_UPDATE, FACT, VEHICLE_POSITION
from tramline.sources.commits import CommitLog
from tramline.sources.tables import read_table, write_table

KEYS = {"trip_id": "t", "route_id": "r", "stop_id": "s"}
MIDNIGHT = 1704153600  # 2024-01-02 00:00 UTC
HOUR = 3600
DAYS = {"first": date(2024, 1, 2), "last": date(2024, 1, 3)}


@pytest.fixture
def lake(rows, tmp_path):
    def arrive(*seconds):
        positions = [KEYS | {"vehicle_id": f"v{s}", "vehicle_timestamp": s, "latitude": float("nan")} for s in seconds]
        updates = [
            KEYS | {"arrival_time": i, "ingested_at": datetime.fromtimestamp(s)} for s in seconds if s for i in (1, 2)
        ]
        write_table(rows(VEHICLE_POSITION, *positions), f"{tmp_path}/bronze/vehicle_positions", mode="append")
        write_table(rows(BRONZE_TRIP_UPDATE, *updates), f"{tmp_path}/bronze/trip_updates", mode="append")

    arrive(MIDNIGHT - HOUR, MIDNIGHT, MIDNIGHT + HOUR, MIDNIGHT + 25 * HOUR, MIDNIGHT + 49 * HOUR, None)
    arrive.path = str(tmp_path)
    return arrive


def whole(spark, lake, **days):
    target = f"{lake.path}/whole{len(os.listdir(lake.path))}"
    append_fact(spark, f"{lake.path}/bronze", target, **days)
    return list(map(str, values(read_table(spark, f"{target}/fact"))))


def run(spark, lake, **days):
    return backfill_fact(spark, f"{lake.path}/bronze", f"{lake.path}/silver", **days)


def kept(table):
    return list(map(str, values(table.read())))


def test_twice_is_once(spark, lake):
    table = run(spark, lake, **DAYS)
    assert kept(run(spark, lake, **DAYS)) == kept(table) == whole(spark, lake, **DAYS)
    assert table.read().columns == list(FACT)


def test_a_broken_run_is_not_read(spark, lake, monkeypatch):
    table = run(spark, lake)
    lake(MIDNIGHT + 5)
    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", lambda *args, **options: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(spark, lake, **DAYS)
    before = kept(table)
    assert len(before) < len(whole(spark, lake))
    run(spark, lake, **DAYS)
    assert kept(table) == whole(spark, lake)


def test_only_the_named_days_are_replaced(spark, lake):
    table = run(spark, lake)
    lake(MIDNIGHT + 26 * HOUR, MIDNIGHT + 50 * HOUR)
    run(spark, lake, first=date(2024, 1, 3), last=date(2024, 1, 3))
    days = [r[0] for r in values(table.read().selectExpr("to_date(vehicle_timestamp)"))]
    assert days.count(date(2024, 1, 3)) == 4 and days.count(date(2024, 1, 4)) == 2 and days.count(None) == 1
    run(spark, lake)
    assert kept(table) == whole(spark, lake)


def test_a_day_can_become_empty(spark, lake):
    table = run(spark, lake)
    table.replace(table.read().limit(0), [date(2024, 1, 2)], "x")
    assert table.read().filter("to_date(vehicle_timestamp) = '2024-01-02'").isEmpty()
    assert table.read().count() == len(whole(spark, lake)) - 4


def test_replaced_folders_can_go(spark, lake):
    table = run(spark, lake)
    run(spark, lake, **DAYS)
    run(spark, lake, first=date(2024, 1, 3), last=date(2024, 1, 3))
    before = kept(table)
    assert table.drop_replaced() == 3  # two days of the first run, one of the second
    assert table.drop_replaced() == 0 and kept(table) == before


def test_empty_table_and_half_given_days(spark, lake, tmp_path):
    table = DayTable(spark, f"{tmp_path}/nothing")
    assert table.read().collect() == [] and table.read().columns == list(FACT)
    with pytest.raises(ValueError, match="both"):
        run(spark, lake, first=date(2024, 1, 2))
    with pytest.raises(ValueError, match="bound"):
        run(spark, lake, bound=None, **DAYS)
