"""Accounts of fact rows, and what they put right."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tramline.operators.account import account, differing, merged
from tramline.operators.fact import build_fact
from tramline.plans.repair import RepairedFact
from tramline.schemas import BRONZE_TRIP_UPDATE, FACT, VEHICLE_POSITION
from tramline.sources.commits import CommitLog
from tramline.sources.tables import read_table, write_table

MIDNIGHT = 1704153600  # 2024-01-02 00:00 UTC
HOUR = 3600


def keys(n):
    return {"trip_id": f"t{n}", "route_id": "r", "stop_id": "s"}


def position(n, at, **more):
    return keys(n) | {"vehicle_id": "v", "vehicle_timestamp": at} | more


def update(n, at, arrival=1):
    return keys(n) | {"arrival_time": arrival, "ingested_at": datetime.fromtimestamp(at)}


@pytest.fixture
def lake(spark, rows, tmp_path):
    class Lake:
        bronze, silver = f"{tmp_path}/bronze", f"{tmp_path}/silver"

        def arrive(self, positions, updates):
            write_table(rows(VEHICLE_POSITION, *positions), f"{self.bronze}/vehicle_positions", mode="append")
            write_table(rows(BRONZE_TRIP_UPDATE, *updates), f"{self.bronze}/trip_updates", mode="append")

        def batch(self, bound=600):
            return build_fact(
                read_table(spark, f"{self.bronze}/vehicle_positions", columns=VEHICLE_POSITION),
                read_table(spark, f"{self.bronze}/trip_updates", columns=BRONZE_TRIP_UPDATE),
                bound,
            )

        def emit(self, fact):
            write_table(fact, f"{self.silver}/fact", mode="append")

    return Lake()


POSITIONS = [position(n, MIDNIGHT + n * 1000, latitude=float("nan")) for n in range(40)] + [position(1, None), position(2, 10**17)]
UPDATES = [update(n, MIDNIGHT + n * 1000 + d, d) for n in range(0, 40, 2) for d in (-600, 0, 600, 601)]


def strings(df):
    return list(map(str, values(df)))


def test_accounts_merge_and_show_every_change(spark, lake):
    lake.arrive(POSITIONS, UPDATES)
    fact = lake.batch().checkpoint()
    whole = account(fact)
    parts = [account(fact.filter(F.pmod(F.xxhash64("trip_id", "arrival_time"), F.lit(3)) == i)) for i in range(3)]
    assert differing(whole, merged(parts[0].union(parts[1]).union(parts[2]))).isEmpty()
    assert differing(whole, account(fact.repartition(7))).isEmpty()
    gone = differing(whole, account(fact.filter("NOT (trip_id = 't2' AND arrival_time <=> 0)"))).collect()
    assert [(r["expected_rows"] - r["given_rows"]) for r in gone] == [1]
    other = fact.withColumn("arrival_uncertainty", F.when(F.col("trip_id") == "t4", 9))
    assert {r["expected_rows"] - r["given_rows"] for r in differing(whole, account(other)).collect()} == {0}
    moved = fact.withColumns({"departure_time": F.col("arrival_time"), "arrival_time": F.col("departure_time")})
    assert not differing(whole, account(moved)).isEmpty()  # a value and a null that change places
    assert differing(account(fact.limit(0)), account(fact.limit(0))).isEmpty()


def test_lost_rows_are_found_and_put_right(spark, lake):
    lake.arrive(POSITIONS, UPDATES)
    kept = lake.batch().filter("vehicle_timestamp IS NOT NULL AND trip_id NOT IN ('t8', 't9')")
    # One position was emitted without its updates, which came late; its row is there but wrong.
    names = ("arrival_time", "departure_time", "arrival_uncertainty", "ingested_at")
    early = [F.when(F.col("trip_id") != "t6", F.col(c)).alias(c) if c in names else c for c in FACT]
    lake.emit(kept.select(*early).distinct())
    fact = RepairedFact(spark, lake.silver)
    wrong = fact.repair(lake.bronze)
    assert {(r["expected_rows"], r["given_rows"]) for r in wrong.collect()} >= {(3, 0), (1, 0), (3, 1)}
    assert strings(fact.read()) == strings(lake.batch())
    assert fact.read().columns == list(FACT)
    assert fact.repair(lake.bronze).isEmpty() and fact.take_in() == 0


def test_only_wrong_windows_are_joined_again(spark, lake):
    lake.arrive(POSITIONS, UPDATES)
    lake.emit(lake.batch().filter("trip_id <> 't8'"))
    fact = RepairedFact(spark, lake.silver)
    fact.repair(lake.bronze)
    (run,) = fact.repaired.runs()
    assert {r["trip_id"] for r in spark.read.parquet(f"{fact.path}/rows/run={run}").collect()} == {"t8"}


def test_by_days(spark, lake):
    second_day = [position(n, MIDNIGHT + 86_400 + n) for n in range(3)]
    lake.arrive(POSITIONS + second_day, UPDATES)
    fact = RepairedFact(spark, lake.silver)
    days = {"first": date(2024, 1, 3), "last": date(2024, 1, 3)}
    assert sum(r["expected_rows"] for r in fact.repair(lake.bronze, **days).collect()) == 3
    assert fact.read().count() == 3 and fact.lost(lake.bronze, **days).isEmpty()
    assert not fact.lost(lake.bronze, last=date(2024, 1, 2)).isEmpty()
    fact.repair(lake.bronze)
    assert strings(fact.read()) == strings(lake.batch())
    assert fact.lost(lake.bronze, first=date(2024, 1, 1)).isEmpty()


def test_rows_that_come_later_still(spark, lake):
    lake.arrive(POSITIONS, UPDATES)
    fact = RepairedFact(spark, lake.silver)
    fact.repair(lake.bronze)
    more = [update(5, MIDNIGHT + 5000), update(5, MIDNIGHT + 5000)]
    lake.arrive([position(41, MIDNIGHT)], more)
    lake.emit(lake.batch().filter("trip_id = 't41'"))
    fact.repair(lake.bronze)
    assert strings(fact.read()) == strings(lake.batch())


def test_a_broken_repair_changes_nothing(spark, lake, monkeypatch):
    lake.arrive(POSITIONS, UPDATES)
    lake.emit(lake.batch().filter("trip_id <> 't8'"))
    fact = RepairedFact(spark, lake.silver)
    fact.take_in()
    before = strings(fact.read())
    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", lambda *args, **options: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            fact.repair(lake.bronze)
    assert strings(fact.read()) == before
    fact.repair(lake.bronze)
    assert strings(fact.read()) == strings(lake.batch())


def test_wide_bounds_reach_over_several_windows(spark, lake):
    lake.arrive([position(1, MIDNIGHT)], [update(1, MIDNIGHT + s) for s in (-3 * HOUR, -7 * HOUR, 5 * HOUR, 6 * HOUR, 6 * HOUR + 1)])
    fact = RepairedFact(spark, lake.silver)
    fact.repair(lake.bronze, 6 * HOUR)
    assert strings(fact.read()) == strings(lake.batch(6 * HOUR)) and fact.read().count() == 3
