"""Layouts: a curve over two columns, and buckets that joins need not shuffle."""

import random
from datetime import date, timedelta
from glob import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, values
from tramline.operators.layout import curve_place, cut_points, laid_out
from tramline.plans import warehouse
from tramline.schemas import WAREHOUSE

FIRST = date(2024, 1, 1)


@pytest.fixture
def fact(spark, rows):
    draw = random.Random(5)
    data = [
        {
            "fact_id": i,
            "route_id": None if i % 97 == 0 else f"R{draw.randrange(64):02d}",
            "date_id": None if i % 89 == 0 else FIRST + timedelta(days=draw.randrange(64)),
            "trip_id": f"t{i % 50}",
            "stop_id": f"s{i % 7}",
            "vehicle_id": f"v{i % 9}",
        }
        for i in range(20_000)
    ]
    return rows(WAREHOUSE["fact_stop_delay"], *data).checkpoint()


def row_groups(path):
    for name in glob(f"{path}/*.parquet"):
        footer = pq.ParquetFile(name).metadata
        for i in range(footer.num_row_groups):
            group = footer.row_group(i)
            yield {group.column(c).path_in_schema: group.column(c).statistics for c in range(group.num_columns)}


def read_share(path, column, value):
    """Which share of the row groups a reader cannot skip for an equality."""
    groups = [g[column] for g in row_groups(path)]
    return sum(s.has_min_max and s.min <= value <= s.max for s in groups) / len(groups)


def test_either_filter_reads_a_small_share(spark, fact, tmp_path):
    path = f"{tmp_path}/fact"
    assert warehouse.save_for_filters(fact, path, rows_per_file=313) == 64
    got = spark.read.parquet(path)
    assert values(got.select("fact_id")) == values(fact.select("fact_id"))
    routes = [read_share(path, "route_id", f"R{i:02d}") for i in range(64)]
    days = [read_share(path, "date_id", FIRST + timedelta(days=i)) for i in range(64)]
    assert max(routes) < 0.4 and sum(routes) / 64 < 0.3
    assert max(days) < 0.4 and sum(days) / 64 < 0.3
    # By date alone, as before, a route is in every file.
    fact.repartitionByRange(64, "date_id").write.parquet(f"{tmp_path}/by_date")
    assert read_share(f"{tmp_path}/by_date", "route_id", "R31") > 0.9
    assert "PushedFilters: [IsNotNull(route_id), EqualTo(route_id,R31)]" in plan_of(got.filter("route_id = 'R31'"))


def test_curve_takes_bits_in_turn(spark):
    points = [[1, 2, 3], ["b", "c", "d"]]
    rows = spark.createDataFrame([(a, b) for a in range(4) for b in "abcd"] + [(None, None)], "x int, y string")
    places = {(r.x, r.y): r.place for r in rows.withColumn("place", curve_place(["x", "y"], points, 2)).collect()}
    assert sorted(p for k, p in places.items() if k[0] is not None) == list(range(16))
    assert places[0, "b"] == 1 and places[1, "a"] == 2 and places[2, "a"] == 8 and places[None, None] == 0
    with pytest.raises(ValueError, match="too many"):
        curve_place(["x"] * 11, [[]] * 11)


def test_hot_values_are_spread(spark):
    rows = spark.range(10_000).select(F.lit("hot").alias("route_id"), F.lit(FIRST).alias("date_id"), "id")
    sizes = [r["count"] for r in laid_out(rows, ["route_id", "date_id"], 8).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3000


def test_empty_and_all_null(spark, tmp_path):
    empty = spark.createDataFrame([], "route_id string, date_id date")
    assert cut_points(empty, ["route_id", "date_id"]) == [[], []]
    warehouse.save_for_filters(empty, f"{tmp_path}/a")
    assert spark.read.schema(empty.schema).parquet(f"{tmp_path}/a").count() == 0
    nulls = spark.createDataFrame([(None, None)] * 3, "route_id string, date_id date")
    assert laid_out(nulls, ["route_id", "date_id"], 2).count() == 3


@pytest.fixture
def database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE bucketed LOCATION '{tmp_path}/db'")
    yield "bucketed"
    spark.sql("DROP DATABASE bucketed CASCADE")


def test_bucketed_lookup_shuffles_no_fact_row(spark, fact, database):
    trips = spark.createDataFrame([(f"t{i}", f"head {i}") for i in range(0, 50, 2)], "trip_id string, trip_headsign string")
    stops = spark.createDataFrame([(f"s{i}", f"stop {i}") for i in range(5)], "stop_id string, stop_name string")
    warehouse.store_bucketed(fact, f"{database}.fact", "trip_id", 4)
    warehouse.store_bucketed(trips, f"{database}.trips", "trip_id", 4)
    dims = {"dim_trip": spark.table(f"{database}.trips"), "dim_stop": stops}
    got = warehouse.bucketed_lookup(spark.table(f"{database}.fact"), dims, "trip_id")
    plan = plan_of(got)
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan and plan.count("BroadcastExchange") == 1
    want = warehouse.star_lookup(fact, {"dim_trip": trips, "dim_stop": stops})
    assert values(got.select(*want.columns)) == values(want)


def test_a_second_large_dimension_is_shuffled(spark, fact, database):
    stops = spark.createDataFrame([(f"s{i}", f"stop {i}") for i in range(5)], "stop_id string, stop_name string")
    warehouse.store_bucketed(fact, f"{database}.fact", "trip_id", 4)
    got = warehouse.bucketed_lookup(spark.table(f"{database}.fact"), {"dim_stop": stops}, "trip_id", broadcast_rows=0)
    assert values(got.select("fact_id", "stop_name")) == values(warehouse.star_lookup(fact, {"dim_stop": stops}).select("fact_id", "stop_name"))
