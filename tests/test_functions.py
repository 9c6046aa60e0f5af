"""Key filter, epochs, clock times, enums."""

from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tramline.functions import (
    STOP_STATUS,
    TRIP_RELATIONSHIP,
    clock_seconds,
    enum_name,
    from_epoch,
    has_keys,
    known_epoch,
    new_load_number,
    service_time,
    time_slot,
)


@pytest.fixture(params=["UTC", "Europe/Budapest"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("column", ["trip_id", "route_id", "stop_id"])
def test_key_filter(spark, column):
    kept = []
    for key in ["x", "\t", " x ", None, "", "   "]:
        row = {"trip_id": "t", "route_id": "r", "stop_id": "s"} | {column: key}
        table = spark.createDataFrame([row], "trip_id string, route_id string, stop_id string")
        kept += [r[column] for r in table.filter(has_keys()).collect()]
    assert kept == ["x", "\t", " x "]


def test_epochs_of_the_repeated_hour_stay_apart(spark, zone):
    epochs = spark.createDataFrame([(0,), (None,), (1729987200,), (1729990800,)], "s bigint")
    back = [row[0] for row in epochs.select(F.unix_seconds(from_epoch(F.col("s")))).collect()]
    assert back == [0, None, 1729987200, 1729990800]


def test_numbers_that_are_no_instants_are_null(spark):
    bad = [1_704_067_200_000_000, 2**63 - 1, -(2**63), 253_402_300_800, -62_135_596_801]
    good = [253_402_300_799, -62_135_596_800, 1]
    epochs = spark.createDataFrame([(s,) for s in bad + good], "s bigint")
    back = epochs.select(F.unix_seconds(from_epoch(F.col("s"))), known_epoch(F.col("s"))).collect()
    assert [tuple(row) for row in back] == [(None, None)] * 5 + [(s, s) for s in good]


def test_clock_text_out_of_range_is_null(spark):
    texts = spark.createDataFrame([("999999999:00:00",), ("-2147483648:00:00",), ("1000:00:00",), ("1:99999999999:0",)], "c string")
    assert [row[0] for row in texts.select(clock_seconds(F.col("c"))).collect()] == [None, None, 3_600_000, None]


def test_zero_is_unknown(spark):
    epochs = spark.createDataFrame([(0,), (None,), (5,)], "s bigint")
    assert [row[0] for row in epochs.select(known_epoch(F.col("s"))).collect()] == [None, None, 5]


def test_clock_text(spark):
    texts = spark.createDataFrame([("00:00:01",), ("25:30:15",), (" 7:05:00",), ("x:1:2",), ("7:30",), (None,)], "c string")
    assert [row[0] for row in texts.select(clock_seconds(F.col("c"))).collect()] == [1, 91815, 25500, None, None, None]


def test_service_time_counts_from_noon_minus_twelve_hours(spark, zone):
    days = spark.createDataFrame([(date(2024, 10, 26), 3600), (date(2024, 10, 27), 8 * 3600)], "d date, s int")
    got = [
        row[0]
        for row in days.select(F.unix_seconds(service_time(F.col("d"), F.col("s"), "Europe/Budapest"))).collect()
    ]
    # Summer time on the 26th; on the 27th the clocks go back, so noon minus 12 h is 01:00 summer time.
    assert got == [
        int(datetime(2024, 10, 25, 23, tzinfo=timezone.utc).timestamp()),
        int(datetime(2024, 10, 27, 7, tzinfo=timezone.utc).timestamp()),
    ]


def test_time_slots_are_whole_and_floor(spark):
    micros = [0, 599_999_999, 600_000_000, -1, -600_000_000, 1_700_000_000_000_000, 1_700_000_399_999_999]
    table = spark.createDataFrame([(m,) for m in micros], "m bigint")
    assert [row[0] for row in table.select(time_slot(F.col("m"), 600)).collect()] == [m // 600_000_000 for m in micros]


def test_enum_names(spark):
    numbers = spark.createDataFrame([(0,), (3,), (4,), (8,), (99,), (None,)], "n int")
    assert [row[0] for row in numbers.select(enum_name(F.col("n"), TRIP_RELATIONSHIP)).collect()] == [
        "SCHEDULED",
        "CANCELED",
        None,
        "NEW",
        None,
        None,
    ]
    assert numbers.select(enum_name(F.col("n"), STOP_STATUS)).first()[0] == "INCOMING_AT"


def test_load_number_format():
    assert new_load_number(datetime(2024, 1, 2, 3, 4, 5)) == "20240102_030405"
