"""Stop delays from new files alone, equal to those from all of bronze."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, values
from tramline.plans import incremental, warehouse
from tramline.schemas import BRONZE_TRIP_UPDATE, STOP_TIMES, VEHICLE_POSITION, WAREHOUSE
from tramline.sources.commits import CommitLog, new_files
from tramline.sources.tables import read_table, write_table

MIDNIGHT = 1704153600  # 2024-01-02 00:00 UTC
STAMPS = ("ingested_at", "load_number")


def position(day, at, **more):
    keys = {"trip_id": "t", "route_id": "r", "stop_id": "s", "vehicle_id": "v", "current_status": "STOPPED_AT"}
    return keys | {"start_date": day, "vehicle_timestamp": at} | more


def update(day, feed, arrival, **more):
    keys = {"trip_id": "t", "route_id": "r", "stop_id": "s"}
    return keys | {"start_date": day, "feed_timestamp": feed, "arrival_time": arrival} | more


LOADS = [
    (
        [position("20240102", MIDNIGHT + 50, speed=4.0), position("20240103", MIDNIGHT + 90_000), position(None, 7, speed=1.0)],
        [update("20240102", 1, MIDNIGHT + 900), update("20240103", 5, MIDNIGHT + 95_000)],
    ),
    (
        [position("20240102", MIDNIGHT + 40, speed=1.0), position("20240102", None, vehicle_id="w"), position("bad", 9)],
        [update("20240102", 2, MIDNIGHT + 80), update("20240102", 2, MIDNIGHT + 70), update("20240102", 3, 0)],
    ),
    ([position("20240104", MIDNIGHT + 180_000, trip_id=" "), position("20240102", 0, speed=float("nan"))], [update("20240103", 9, MIDNIGHT + 99_000)]),
]


@pytest.fixture
def lake(rows, tmp_path):
    class Lake:
        path = f"{tmp_path}/a b"
        bronze, star = f"{path}/bronze", f"{path}/star"
        times = rows(STOP_TIMES, {"trip_id": "t", "stop_id": "s", "arrival_time": "00:01:00"})

        def arrive(self, load, **options):
            positions, updates = load
            write_table(rows(VEHICLE_POSITION, *positions), f"{self.bronze}/vehicle_positions", mode="append", **options)
            write_table(rows(BRONZE_TRIP_UPDATE, *updates), f"{self.bronze}/trip_updates", mode="append", **options)

        def load(self, spark, number, **options):
            return incremental.load_delays(spark, self.bronze, self.star, self.times, number, **options)

        def whole(self, spark):
            tables = [
                read_table(spark, f"{self.bronze}/{name}", columns=columns)
                for name, columns in (("vehicle_positions", VEHICLE_POSITION), ("trip_updates", BRONZE_TRIP_UPDATE))
            ]
            return list(map(str, values(warehouse.stop_delay(*tables, self.times, "x").drop(*STAMPS))))  # NaN is NaN

        def kept(self, spark):
            fact = read_table(spark, f"{self.star}/fact_stop_delay", columns=WAREHOUSE["fact_stop_delay"])
            return list(map(str, values(fact.select(*[c for c in WAREHOUSE["fact_stop_delay"] if c not in STAMPS]))))

    return Lake()


def folders(path):
    return {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if "=" in d}


@pytest.mark.parametrize("layout", [(), ("start_date",)])
def test_loads_equal_the_whole_and_touch_only_their_dates(spark, lake, layout):
    touched, before = [], {}
    for i, load in enumerate(LOADS):
        lake.arrive(load, partition_by=layout)
        touched.append(lake.load(spark, f"L{i}"))
        assert lake.kept(spark) == lake.whole(spark)
        now = folders(f"{lake.star}/fact_stop_delay")
        for folder in before.keys() & now.keys():
            day = folder.removeprefix("date_id=")
            same = day not in {str(d) for d in touched[-1]} and not (None in touched[-1] and day.startswith("__"))
            assert (before[folder] == now[folder]) == same
        before = now
    days = [date(2024, 1, d) for d in (2, 3)]
    assert set(touched[0]) == {None, *days} and set(touched[1]) == {None, days[0]} and set(touched[2]) == set(days)


def test_nothing_new_changes_nothing(spark, lake):
    lake.arrive(LOADS[0])
    lake.load(spark, "L0")
    before = folders(f"{lake.star}/fact_stop_delay")
    assert lake.load(spark, "L0") == []
    assert folders(f"{lake.star}/fact_stop_delay") == before


def test_a_load_broken_before_its_commit_leaves_nothing(spark, lake, monkeypatch):
    lake.arrive(LOADS[0])
    lake.load(spark, "L0")
    lake.arrive(LOADS[1])
    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", lambda *args, **options: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            lake.load(spark, "L1")
    lake.load(spark, "L1")
    assert lake.kept(spark) == lake.whole(spark)


@pytest.mark.parametrize("point", ["delays_of", "_published"])
def test_a_load_broken_after_its_commit_is_finished_by_the_next(spark, lake, monkeypatch, point):
    lake.arrive(LOADS[0])
    lake.load(spark, "L0")
    lake.arrive(LOADS[1])
    with monkeypatch.context() as patch:
        if point == "delays_of":
            patch.setattr(incremental.DelayTable, point, lambda *args: 1 / 0)
        else:
            commit = CommitLog.commit

            def broken(self, run, items=(), replaces=()):
                if self.path.endswith("published"):
                    raise ZeroDivisionError
                commit(self, run, items, replaces)

            patch.setattr(CommitLog, "commit", broken)
        with pytest.raises(ZeroDivisionError):
            lake.load(spark, "L1")
    assert set(lake.load(spark, "L2")) == {None, date(2024, 1, 2)}
    assert lake.kept(spark) == lake.whole(spark)


def test_merged_loads_give_the_same(spark, lake):
    for i, load in enumerate(LOADS):
        lake.arrive(load)
        lake.load(spark, f"L{i}", loads=1)
    table = incremental.DelayTable(spark, lake.star)
    assert len(table.loaded.runs()) == 1
    assert new_files(read_table(spark, f"{lake.bronze}/trip_updates", columns=BRONZE_TRIP_UPDATE), table.loaded) == []
    lake.arrive(LOADS[0])
    lake.load(spark, "L9")
    assert lake.kept(spark) == lake.whole(spark)


def test_waiting_dates_are_not_merged(spark, lake):
    lake.arrive(LOADS[0])
    table = incremental.DelayTable(spark, lake.star)
    assert table.take_in(lake.bronze, "L0") > 0
    with pytest.raises(ValueError, match="pending"):
        table.merge_loads("L0")


def test_plan_reads_only_the_touched_dates(spark, lake):
    lake.arrive(LOADS[0])
    lake.load(spark, "L0")
    table = incremental.DelayTable(spark, lake.star)
    states = incremental._of_dates(table._states("visits", incremental.VISIT_STATE, table.loaded.runs()), [date(2024, 1, 3)])
    plan = plan_of(states)
    assert "PartitionFilters: [" in plan and "date_id" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert states.count() == 1 and len({f.rpartition("/")[0] for f in states.inputFiles()}) >= 1
    assert [r[0] for r in states.select(F.input_file_name()).distinct().collect()][0].count("date_id=2024-01-03") == 1


def test_warehouse_updates(spark, lake, rows):
    from tramline.schemas import STATIC_DIMS

    def static(names):
        for table, columns in STATIC_DIMS.items():
            key = f"{table}_id"
            dims = rows({**columns, "load_number": "string"}, *[{key: n, "load_number": "S"} for n in names])
            write_table(dims, f"{lake.bronze}/dim_{table}")

    def read(table):
        return read_table(spark, f"{lake.star}/{table}", columns=WAREHOUSE[table])

    for i, (load, names) in enumerate(zip(LOADS, ("st", "s", "rst"), strict=True)):
        lake.arrive(load)
        static(names)
        stamp = F.timestamp_seconds(F.lit(i + 1))
        runs = incremental.update_warehouse(spark, lake.bronze, lake.star, f"L{i}", lake.times, now=stamp)
        assert [run.status for run in runs] == ["SUCCESS"] * 6
        assert lake.kept(spark) == lake.whole(spark)
        assert read("dim_route").count() == len(names)
    created = read("dim_stop").select("stop_id", F.unix_seconds("created_at"), "load_number")
    assert values(created) == [("r", 3, "L2"), ("s", 1, "L0"), ("t", 1, "L2")]  # t was gone and came back
    assert values(read("dim_vehicle").select("vehicle_id", F.unix_seconds("created_at"))) == [("v", 1), ("w", 2)]
    assert values(read("dim_date").select("date_id")) == [(date(2024, 1, 2),), (date(2024, 1, 3),)]
    assert read("audit_pipeline_runs").count() == 18
    again = incremental.update_warehouse(spark, lake.bronze, lake.star, "L9", lake.times)
    assert again[-1].row_count == 0 and lake.kept(spark) == lake.whole(spark)
