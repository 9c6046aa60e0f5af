"""Schedule files and dimensions."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import plan_of, values
from tramline.operators.dims import latest_vehicles, static_dim, vehicle_dim
from tramline.plans.static import load_static, write_silver_dims
from tramline.schemas import STATIC_DIMS, VEHICLE_POSITION, ddl
from tramline.sources.static import read_schedule_file
from tramline.sources.tables import read_table, write_table

STOPS = (
    "﻿stop_code,stop_id,wheelchair_boarding,stop_name,stop_lat,stop_lon,zone_id\n"
    ',007,1,"Deák ""F"" tér, M",47.5,19.0,z\n'
    "NA,S2,NA,NA,x,19.5,z\n"
)
ROUTES = (
    "route_id,route_short_name,route_long_name,route_type,route_desc,route_color\n"
    "0050,5,,3,tram,FF0000\n"
)
TRIPS = (
    "route_id,trip_id,service_id,trip_headsign,direction_id,shape_id,wheelchair_accessible,bikes_allowed\n"
    "0050,T1,weekday,Center,0,sh1,1,2\n"
)


@pytest.fixture
def files(tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    for name, text in (("stops", STOPS), ("routes", ROUTES), ("trips", TRIPS)):
        (folder / f"{name}.txt").write_text(text, encoding="utf-8")
    return folder


def test_stops_by_name_typed_and_stamped(spark, files):
    dim = static_dim(read_schedule_file(spark, str(files / "stops.txt")), STATIC_DIMS["stop"], "L1")
    assert dim.columns == [*STATIC_DIMS["stop"], "load_number"]
    assert values(dim) == [
        ("007", 'Deák "F" tér, M', 47.5, 19.0, None, 1, "L1"),
        ("S2", "NA", None, 19.5, "NA", None, "L1"),
    ]


def test_line_break_inside_a_field(spark, tmp_path):
    path = tmp_path / "routes.txt"
    path.write_text(ROUTES.replace("tram", '"tr\nam"'))
    rows = read_schedule_file(spark, str(path), multi_line=True)
    assert static_dim(rows, STATIC_DIMS["route"], "L").first().route_desc == "tr\nam"


def test_missing_column_is_an_error_and_replaces_nothing(spark, files, tmp_path):
    (files / "trips.txt").write_text(TRIPS.replace("shape_id", "shape"))
    with pytest.raises(AnalysisException):
        load_static(spark, str(files), str(tmp_path / "bronze"))
    assert not (tmp_path / "bronze").exists()


def test_load_replaces_the_previous_load(spark, files, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    load_static(spark, str(files), bronze, "L1")
    runs = load_static(spark, str(files), bronze, "L2")
    assert [(run.layer, run.status, run.row_count) for run in runs] == [
        ("bronze.dim_route", "SUCCESS", 1),
        ("bronze.dim_stop", "SUCCESS", 2),
        ("bronze.dim_trip", "SUCCESS", 1),
    ]
    write_table(spark.createDataFrame([], ddl(VEHICLE_POSITION)), f"{bronze}/vehicle_positions")
    for _ in range(2):
        write_silver_dims(spark, bronze, silver)
    for name in STATIC_DIMS:
        assert values(read_table(spark, f"{silver}/{name}")) == values(read_table(spark, f"{bronze}/dim_{name}"))
        assert read_table(spark, f"{silver}/{name}").select("load_number").distinct().collect() == [("L2",)]
    assert read_table(spark, f"{silver}/vehicle").count() == 0


KEYS = {"trip_id": "t", "route_id": "r", "stop_id": "s"}


def test_vehicle_dim_keeps_distinct_attributes(rows):
    table = rows(
        VEHICLE_POSITION,
        *[KEYS | {"vehicle_id": "v1", "license_plate": "p"}] * 2,
        KEYS | {"vehicle_id": "v1", "vehicle_label": "L", "license_plate": "p"},
        *[KEYS] * 2,
        {"vehicle_id": "no keys"},
    )
    assert values(vehicle_dim(table)) == [(None, None, None), ("v1", None, "p"), ("v1", "L", "p")]


def test_latest_vehicle_attributes(rows):
    table = rows(
        VEHICLE_POSITION,
        KEYS | {"vehicle_id": "v1", "vehicle_label": "old", "vehicle_timestamp": 1},
        KEYS | {"vehicle_id": "v1", "vehicle_label": "new", "vehicle_timestamp": 9},
        KEYS | {"vehicle_id": "v1", "vehicle_label": "old", "vehicle_timestamp": 5},
        KEYS | {"vehicle_id": "v2", "license_plate": "p"},
        KEYS,
    )
    assert values(latest_vehicles(table)) == [("v1", "new", None), ("v2", None, "p")]


def test_vehicle_dim_combines_before_the_shuffle(spark):
    table = spark.range(10_000).select(
        *(F.lit("k").alias(name) for name in ("trip_id", "route_id", "stop_id")),
        F.lit("v").alias("vehicle_id"),
        F.lit("l").alias("vehicle_label"),
        F.lit("p").alias("license_plate"),
    )
    plan = plan_of(vehicle_dim(table))
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1
