"""Flattening of nested feeds: what is absent, what is unset."""

import json

import pytest

from tests.conftest import values
from tramline.operators.feed import poll_counts, trip_updates, vehicle_positions
from tramline.sources.static import read_snapshots

TRIP = {"trip_id": "T", "route_id": "R", "start_date": "20240101", "schedule_relationship": 1}
SNAPSHOTS = [
    {
        "header": {"timestamp": 100},
        "entity": [
            {
                "id": "full",
                "vehicle": {
                    "trip": TRIP,
                    "position": {"latitude": 47.5, "longitude": 19.1, "bearing": 10.5, "speed": 3.5},
                    "current_stop_sequence": 4,
                    "current_status": 1,
                    "stop_id": "S",
                    "timestamp": 99,
                    "vehicle": {"id": "v", "label": "l", "license_plate": "p"},
                },
            },
            {"id": "bare", "vehicle": {}},
            {"id": "unset", "vehicle": {"trip": {"trip_id": "T"}, "position": {"latitude": 1.5}, "vehicle": {"id": "v"}}},
            {"id": "enum", "vehicle": {"trip": TRIP | {"schedule_relationship": 77}, "current_status": 9}},
            {"id": "alert"},
        ],
    },
    {
        "header": {"timestamp": 200},
        "entity": [
            {
                "id": "update",
                "trip_update": {
                    "trip": TRIP,
                    "stop_time_update": [
                        {"stop_sequence": 1, "stop_id": "A", "arrival": {"time": 7, "uncertainty": 2}, "departure": {"time": 8}},
                        {"stop_id": "B", "arrival": {}, "departure": {}},
                        {"stop_sequence": 3},
                    ],
                },
            },
            {"id": "no stops", "trip_update": {"trip": TRIP, "stop_time_update": []}},
            {"id": "no list", "trip_update": {"trip": TRIP}},
            {"id": "no trip", "trip_update": {"stop_time_update": [{"stop_id": "C"}]}},
        ],
    },
]


@pytest.fixture(scope="module")
def snapshots(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("feed") / "snapshots.json"
    path.write_text("\n".join(json.dumps(snapshot) for snapshot in SNAPSHOTS))
    return read_snapshots(spark, str(path))


def test_vehicles(snapshots):
    got = {row.entity_id: tuple(row)[1:] for row in vehicle_positions(snapshots).collect()}
    assert got == {
        "full": (100, "T", "R", "20240101", "ADDED", 47.5, pytest.approx(19.1, abs=1e-5), 10.5, 3.5, 4, "STOPPED_AT",
                 "S", 99, "v", "l", "p"),
        "bare": (100, *[None] * 15),
        "unset": (100, "T", "", "", "SCHEDULED", 1.5, 0.0, 0.0, 0.0, None, None, None, None, "v", "", ""),
        "enum": (100, "T", "R", "20240101", None, *[None] * 11),
    }


def test_positions_widen_without_rounding(snapshots):
    row = vehicle_positions(snapshots).filter("entity_id = 'full'").first()
    assert row.longitude == 19.100000381469727  # 19.1 as a 32-bit float


def test_trip_updates(snapshots):
    trip = ("T", "R", "20240101", "ADDED")
    assert values(trip_updates(snapshots)) == sorted(
        [
            ("no trip", 200, None, None, None, None, None, "C", None, None, None),
            ("update", 200, *trip, 1, "A", 7, 2, 8),
            ("update", 200, *trip, None, "B", 0, 0, 0),
            ("update", 200, *trip, 3, None, None, None, None),
        ],
        key=lambda row: tuple((v is not None, str(v)) for v in row),
    )


def test_counts_per_poll(snapshots):
    assert values(poll_counts(vehicle_positions(snapshots))) == [(100, 4)]
    assert values(poll_counts(trip_updates(snapshots))) == [(200, 4)]
