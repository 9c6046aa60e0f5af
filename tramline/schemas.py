"""Column contracts of every table: column name to Spark SQL type, in column order."""

from __future__ import annotations

Columns = dict[str, str]


def _columns(text: str) -> Columns:
    return dict(column.split() for column in text.split(","))


def ddl(columns: Columns) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


# Message fields of the two real-time topics.
VEHICLE_POSITION = _columns(
    """
    entity_id string, feed_timestamp bigint,
    trip_id string, route_id string, start_date string, schedule_relationship string,
    latitude double, longitude double, bearing float, speed float,
    current_stop_sequence int, current_status string, stop_id string, vehicle_timestamp bigint,
    vehicle_id string, vehicle_label string, license_plate string
    """
)
TRIP_UPDATE = _columns(
    """
    entity_id string, feed_timestamp bigint,
    trip_id string, route_id string, start_date string, schedule_relationship string,
    stop_sequence int, stop_id string,
    arrival_time bigint, arrival_uncertainty int, departure_time bigint
    """
)
BRONZE_TRIP_UPDATE = {**TRIP_UPDATE, "ingested_at": "timestamp"}

# One row of a raw topic; only the payload is ever read.
RAW_MESSAGE = _columns("value binary")

# Nested, so kept as one DDL string.
_TRIP = "struct<trip_id:string, route_id:string, start_date:string, schedule_relationship:int>"
_EVENT = "struct<time:bigint, uncertainty:int>"
FEED_SNAPSHOT = (
    f"""
    header struct<timestamp:bigint>,
    entity array<struct<
      id:string,
      vehicle:struct<
        trip:{_TRIP},
        position:struct<latitude:float, longitude:float, bearing:float, speed:float>,
        current_stop_sequence:int, current_status:int, stop_id:string, timestamp:bigint,
        vehicle:struct<id:string, label:string, license_plate:string>>,
      trip_update:struct<
        trip:{_TRIP},
        stop_time_update:array<struct<
          stop_sequence:int, stop_id:string, arrival:{_EVENT}, departure:{_EVENT}>>>>>
    """
)

# Static schedule files, the columns kept from each and their types.
STATIC_DIMS = {
    "route": _columns(
        "route_id string, route_short_name string, route_long_name string, "
        "route_type int, route_desc string, route_color string"
    ),
    "stop": _columns(
        "stop_id string, stop_name string, stop_lat double, stop_lon double, "
        "stop_code string, wheelchair_boarding int"
    ),
    "trip": _columns(
        "route_id string, trip_id string, service_id string, trip_headsign string, "
        "direction_id string, shape_id string, wheelchair_accessible int, bikes_allowed int"
    ),
}
STATIC_FILES = {"route": "routes.txt", "stop": "stops.txt", "trip": "trips.txt"}

VEHICLE_DIM = _columns("vehicle_id string, vehicle_label string, license_plate string")

FACT = _columns(
    """
    trip_id string, route_id string, stop_id string, vehicle_id string,
    latitude double, longitude double, speed float, bearing float,
    current_status string, vehicle_timestamp timestamp,
    arrival_time bigint, departure_time bigint, arrival_uncertainty int, ingested_at timestamp
    """
)

STOP_TIMES = _columns("trip_id string, stop_id string, stop_sequence int, arrival_time string")

# The declared warehouse star.
WAREHOUSE = {
    "dim_route": _columns(
        "route_id string, route_short_name string, route_long_name string, route_type int, "
        "route_desc string, route_color string, created_at timestamp, load_number string"
    ),
    "dim_stop": _columns(
        "stop_id string, stop_name string, stop_lat double, stop_lon double, stop_code string, "
        "wheelchair_boarding int, created_at timestamp, load_number string"
    ),
    "dim_trip": _columns(
        "trip_id string, route_id string, service_id string, trip_headsign string, "
        "direction_id string, shape_id string, wheelchair_accessible int, bikes_allowed int, "
        "created_at timestamp, load_number string"
    ),
    "dim_vehicle": _columns(
        "vehicle_id string, license_plate string, vehicle_model string, wheelchair_accessible string, "
        "created_at timestamp, updated_at timestamp, load_number string"
    ),
    "dim_date": _columns("date_id date, day_of_week int, is_weekend boolean, is_holiday boolean"),
    "fact_stop_delay": _columns(
        "fact_id bigint, vehicle_id string, route_id string, trip_id string, stop_id string, date_id date, "
        "scheduled_arrival timestamp, estimated_arrival timestamp, actual_arrival timestamp, "
        "delay_seconds int, avg_speed_segment double, weather_condition string, "
        "ingested_at timestamp, load_number string"
    ),
    "audit_pipeline_runs": _columns(
        "run_id bigint, load_number string, layer string, status string, row_count bigint, "
        "start_time timestamp, end_time timestamp"
    ),
}

# What a load remembers between runs: a record per committed run, and partial results per stop visit.
COMMIT = _columns("number bigint, run string, items array<string>, replaces array<string>")
_VISIT = "start_date string, route_id string, trip_id string, stop_id string"
VISIT_STATE = _columns(f"{_VISIT}, vehicle_id string, first_stopped bigint, speed_sum double, speed_count bigint")
VEHICLE_STATE = {**VEHICLE_DIM, "seen_at": "bigint"}
PREDICTION_STATE = _columns(f"{_VISIT}, feed_timestamp bigint, arrival bigint")
# Rows of a stream's key cells by window, and since when (epoch microseconds) a cell has how many parts.
ROUTE_COUNT = _columns(
    "cell int, slot bigint, left_rows bigint, right_rows bigint, latest bigint, processed boolean"
)
ROUTE = _columns("cell int, since bigint, left_parts int, right_parts int, generation int")
# Accounts of fact rows by key cell and time window, and the windows in which two differ.
_PLACE = _columns("cell int, window bigint")
ACCOUNT = {**_PLACE, "row_count": "bigint", "digest": "decimal(38,0)"}
LOST_WINDOW = {**_PLACE, "expected_rows": "bigint", "given_rows": "bigint"}

PRIMARY_KEYS = {
    "dim_route": ["route_id"],
    "dim_stop": ["stop_id"],
    "dim_trip": ["trip_id"],
    "dim_vehicle": ["vehicle_id"],
    "dim_date": ["date_id"],
    "fact_stop_delay": ["fact_id"],
    "audit_pipeline_runs": ["run_id"],
}

# (child table, column, parent table); the column has the same name on both sides.
FOREIGN_KEYS = [
    ("dim_trip", "route_id", "dim_route"),
    ("fact_stop_delay", "vehicle_id", "dim_vehicle"),
    ("fact_stop_delay", "route_id", "dim_route"),
    ("fact_stop_delay", "trip_id", "dim_trip"),
    ("fact_stop_delay", "stop_id", "dim_stop"),
    ("fact_stop_delay", "date_id", "dim_date"),
]
