"""Topic payloads, good and bad."""

import json
import math
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tramline.operators.messages import decode, encode, stamp_ingest
from tramline.schemas import RAW_MESSAGE, TRIP_UPDATE, VEHICLE_POSITION, ddl

GOOD = {name: None for name in VEHICLE_POSITION} | {
    "entity_id": "e1",
    "feed_timestamp": 1700000000,
    "trip_id": "T1",
    "latitude": 47.123456789,
    "bearing": 90.5,
    "current_stop_sequence": 3,
    "vehicle_timestamp": 1700000001,
}


def decoded(spark, *payloads):
    raw = [(p if p is None else p.encode(),) for p in payloads]
    return decode(spark.createDataFrame(raw, ddl(RAW_MESSAGE)), VEHICLE_POSITION)


def test_good_message_with_unknown_key(spark):
    (row,) = decoded(spark, json.dumps(GOOD | {"extra": {"a": 1}})).collect()
    assert row.asDict() == GOOD


@pytest.mark.parametrize("payload", ["not json", "", None, "[1, 2]"])
def test_unreadable_message_is_an_all_null_row(spark, payload):
    (row,) = decoded(spark, payload).collect()
    assert set(row) == {None}


@pytest.mark.parametrize(
    ("field", "text"),
    [
        ("feed_timestamp", '"abc"'),
        ("current_stop_sequence", "1.5"),
        ("current_stop_sequence", "99999999999"),
        ("latitude", '"47.1"'),
    ],
)
def test_badly_typed_field_is_null_and_the_rest_stays(spark, field, text):
    (row,) = decoded(spark, json.dumps(GOOD).replace(f'"{field}": {json.dumps(GOOD[field])}', f'"{field}": {text}')).collect()
    assert row.asDict() == GOOD | {field: None}


def test_number_for_text_case_and_nan(spark):
    (row,) = decoded(spark, '{"entity_id":5,"TRIP_ID":"x","latitude":NaN}').collect()
    assert row.entity_id == "5"
    assert row.trip_id is None
    assert math.isnan(row.latitude)


def test_round_trip_writes_nulls(spark, rows):
    table = rows(VEHICLE_POSITION, GOOD, {"entity_id": "é\"\n", "speed": 0.1})
    sent = encode(table)
    assert sent.dtypes == [("value", "binary")]
    payloads = [json.loads(bytes(row.value)) for row in sent.collect()]
    assert all(list(payload) == list(VEHICLE_POSITION) for payload in payloads)
    assert values(decode(sent, VEHICLE_POSITION)) == values(table)


def test_ingest_time_is_processing_time_or_a_given_clock(rows):
    table = rows(TRIP_UPDATE, {"feed_timestamp": 60})
    before = datetime.now(timezone.utc)
    (stamped,) = stamp_ingest(table).select(F.unix_micros("ingested_at")).first()
    assert before.timestamp() * 1e6 - 1 <= stamped <= datetime.now(timezone.utc).timestamp() * 1e6
    replayed = stamp_ingest(table, F.timestamp_seconds("feed_timestamp"))
    assert replayed.select(F.unix_seconds("ingested_at")).first()[0] == 60
