"""Every query with its comparison SQL, keyed by name."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs
from checks.inputs import EVENTS_SQL, LOAD_NUMBER, STOP_DELAY_SQL
from tramline.functions import JOIN_KEYS, STOP_STATUS, TRIP_RELATIONSHIP, enum_name, from_epoch
from tramline.operators import dims, feed, messages, quality
from tramline.operators.account import NO_TIME
from tramline.operators.fact import build_fact, clean_positions, clean_updates
from tramline.operators.skew import ROWS_PER_TASK
from tramline.plans import audit, incremental, static, warehouse
from tramline.plans.dimensions import DimensionTable
from tramline.plans.fact import append_fact, backfill_fact
from tramline.plans.late import HeldFacts, infer_members
from tramline.plans.repair import RepairedFact
from tramline.schemas import STATIC_DIMS, TRIP_UPDATE, VEHICLE_POSITION, WAREHOUSE
from tramline.session import run_dir, stream_session
from tramline.sources.static import read_snapshots
from tramline.sources.tables import UNTIL_DRAINED, read_table, write_table
from tramline.sources.topics import write_topic
from tramline.streaming import adaptive, jobs, state

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

SIX_HOURS = 6 * 3600


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            """The given tables hold UTC wall-clock times."""
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(spark, sf_dir)

        QUERIES[name] = in_utc
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def comparable(rows: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock values and floats as doubles, the types the comparison reads."""
    wanted = {"timestamp": "timestamp_ntz", "float": "double"}
    return rows.select(*(F.col(name).cast(wanted.get(kind, kind)).alias(name) for name, kind in rows.dtypes))


def names(columns: dict[str, str], **changed: str) -> str:
    return ", ".join(f"{changed[name]} as {name}" if name in changed else name for name in columns)


POSITION_NAMES = names(VEHICLE_POSITION, bearing="cast(bearing as double)", speed="cast(speed as double)")


# --- key filter, epochs, enums ---------------------------------------------------------------


@query(
    "clean_vehicle_positions",
    f"""with {EVENTS_SQL} select entity_id, feed_timestamp, trip_id, route_id, start_date, schedule_relationship,
    latitude, longitude, cast(bearing as double) as bearing, cast(speed as double) as speed, current_stop_sequence,
    current_status, stop_id, cvp.at as vehicle_timestamp, vehicle_id from cvp""",
)
def _(spark, sf_dir):
    return comparable(clean_positions(inputs.positions(spark, sf_dir)))


@query("clean_trip_updates", f"with {EVENTS_SQL} select {names(TRIP_UPDATE)}, ingested_at from ctu")
def _(spark, sf_dir):
    return comparable(clean_updates(inputs.bronze_updates(spark, sf_dir)))


@query(
    "epoch_to_timestamp",
    "select o_orderkey, make_timestamp(epoch_us(o_orderdate) // 1000000 * 1000000) as ordered_at from orders",
)
def _(spark, sf_dir):
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", seconds.alias("seconds"))
    return comparable(orders.select("o_orderkey", from_epoch(F.col("seconds")).alias("ordered_at")))


@query(
    "enum_names",
    """select l_orderkey, l_linenumber,
    case l_linenumber when 1 then 'ADDED' when 2 then 'UNSCHEDULED' when 3 then 'CANCELED' when 5 then 'REPLACEMENT'
      when 6 then 'DUPLICATED' when 7 then 'DELETED' end as relationship,
    case l_linenumber - 1 when 0 then 'INCOMING_AT' when 1 then 'STOPPED_AT' when 2 then 'IN_TRANSIT_TO' end as status
    from lineitem""",
)
def _(spark, sf_dir):
    number = F.col("l_linenumber")
    return inputs.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        enum_name(number, TRIP_RELATIONSHIP).alias("relationship"),
        enum_name(number - 1, STOP_STATUS).alias("status"),
    )


# --- fact ------------------------------------------------------------------------------------


def fact_sql(bound: int | None, timeless: bool = True) -> str:
    """Left join on the three keys, with the time bound in seconds if there is one."""
    near = f"and u.ingested_at between p.at - interval {bound} second and p.at + interval {bound} second"
    return f"""with {EVENTS_SQL}
    select p.trip_id, p.route_id, p.stop_id, p.vehicle_id, p.latitude, p.longitude,
      cast(p.speed as double) as speed, cast(p.bearing as double) as bearing, p.current_status,
      p.at as vehicle_timestamp, u.arrival_time, u.departure_time, u.arrival_uncertainty, u.ingested_at
    from cvp p left join ctu u on p.trip_id = u.trip_id and p.route_id = u.route_id and p.stop_id = u.stop_id
      {near if bound else ''}
    {'' if timeless else 'where p.at is not null'}"""


def fact(bound: int | None, **options) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        positions, updates = inputs.positions(spark, sf_dir), inputs.bronze_updates(spark, sf_dir)
        return comparable(build_fact(positions, updates, bound, **options))

    return build


query("fact_interval_10m", fact_sql(600))(fact(600))
query("fact_interval_6h", fact_sql(SIX_HOURS))(fact(SIX_HOURS))
query("fact_unbounded", fact_sql(None))(fact(None))
# The same results with every cell above a handful of rows treated as hot.
query("fact_interval_6h_split", fact_sql(SIX_HOURS))(fact(SIX_HOURS, rows_per_task=2))
query("fact_unbounded_split", fact_sql(None))(fact(None, rows_per_task=8))


MATCHED = """on p.trip_id = u.trip_id and p.route_id = u.route_id and p.stop_id = u.stop_id
      and u.ingested_at between p.at - interval 6 hour and p.at + interval 6 hour"""


@query(
    "fact_split_signed",
    f"""with {EVENTS_SQL}, p as (
      select *, case current_stop_sequence % 4 when 0 then '-0' when 1 then '0' when 2 then 'nan' else '5' end as sign
      from cvp, (values (1), (2)) as copies(copy))
    select p.trip_id, p.vehicle_id, p.at as vehicle_timestamp, u.ingested_at, p.sign from p left join ctu u {MATCHED}""",
)
def _(spark, sf_dir):
    """Splitting keeps 0.0, -0.0 and NaN apart, and every one of two stored copies."""
    k, at = F.pmod("current_stop_sequence", F.lit(4)), F.col("longitude")
    odd = F.when(k == 0, F.lit(-0.0)).when(k == 1, F.lit(0.0)).when(k == 2, F.lit(float("nan"))).otherwise(F.lit(5.0))
    positions = inputs.positions(spark, sf_dir).withColumn("longitude", odd)
    rows = build_fact(positions.union(positions), inputs.bronze_updates(spark, sf_dir), SIX_HOURS, rows_per_task=2)
    zero = F.when(at.cast("string").startswith("-"), "-0").otherwise("0")
    sign = F.when(F.isnan(at), "nan").when(at == 0, zero).otherwise("5").alias("sign")
    return comparable(rows.select("trip_id", "vehicle_id", "vehicle_timestamp", "ingested_at", sign))


@query(
    "fact_bad_numbers",
    f"""with {EVENTS_SQL}, p as (
      select trip_id, route_id, stop_id, vehicle_id, case when current_stop_sequence % 5 > 1 then cvp.at end as at from cvp)
    select p.trip_id, p.vehicle_id, p.at as vehicle_timestamp, u.ingested_at from p left join ctu u {MATCHED}""",
)
def _(spark, sf_dir):
    """Times in microseconds and times before any calendar are no times."""
    k, at = F.pmod("current_stop_sequence", F.lit(5)), F.col("vehicle_timestamp")
    bad = F.when(k == 0, at * 1_000_000).when(k == 1, F.lit(-(1 << 62)).cast("bigint")).otherwise(at)
    positions = inputs.positions(spark, sf_dir).withColumn("vehicle_timestamp", bad)
    rows = build_fact(positions, inputs.bronze_updates(spark, sf_dir), SIX_HOURS)
    return comparable(rows.select("trip_id", "vehicle_id", "vehicle_timestamp", "ingested_at"))


@query("fact_batch_append", fact_sql(600))
def _(spark, sf_dir):
    lake = run_dir(spark, "fact-batch")
    write_table(inputs.positions(spark, sf_dir), f"{lake}/bronze/vehicle_positions")
    write_table(inputs.bronze_updates(spark, sf_dir), f"{lake}/bronze/trip_updates")
    append_fact(spark, f"{lake}/bronze", f"{lake}/silver")
    return comparable(read_table(spark, f"{lake}/silver/fact"))


@query("fact_backfill_once", fact_sql(600))
def _(spark, sf_dir):
    """Everything once, then the last days twice and once more by a run that breaks before its commit."""
    lake = run_dir(spark, "fact-once")
    write_table(inputs.positions(spark, sf_dir), f"{lake}/bronze/vehicle_positions")
    write_table(inputs.bronze_updates(spark, sf_dir), f"{lake}/bronze/trip_updates")
    backfill_fact(spark, f"{lake}/bronze", f"{lake}/silver")
    last = inputs.table(spark, sf_dir, "events").agg(F.max("ts").cast("date")).first()[0]
    for _ in range(2):
        table = backfill_fact(spark, f"{lake}/bronze", f"{lake}/silver", first=last - timedelta(days=2), last=last)
    table.read().withColumn("day", F.lit(last)).write.partitionBy("day").parquet(f"{table.path}/data/run=broken")
    return comparable(table.read())


POLLS = 40
RESENT_SQL = f"""with {EVENTS_SQL}, resent as (
      select * replace (ingested_at + to_seconds(15 * poll) as ingested_at) from ctu, (select unnest(range({POLLS})) as poll))
    select p.trip_id, p.route_id, p.stop_id, p.vehicle_id, p.latitude, p.longitude,
      cast(p.speed as double) as speed, cast(p.bearing as double) as bearing, p.current_status,
      p.at as vehicle_timestamp, u.arrival_time, u.departure_time, u.arrival_uncertainty, u.ingested_at
    from cvp p left join resent u on p.trip_id = u.trip_id and p.route_id = u.route_id and p.stop_id = u.stop_id
      and u.ingested_at between p.at - interval 600 second and p.at + interval 600 second"""


def _polls(updates: DataFrame) -> DataFrame:
    """Every update sent again at each of the next polls, one after 15 seconds."""
    poll = F.explode(F.sequence(F.lit(0), F.lit(POLLS - 1)))
    later = updates.withColumn("poll", poll).withColumn("feed_timestamp", F.col("feed_timestamp") + 15 * F.col("poll"))
    return later.drop("poll")


query("fact_interval_10m_resent", fact_sql(600))(fact(600, resent=True))


@query("fact_resent_polls", RESENT_SQL)
def _(spark, sf_dir):
    updates = _polls(inputs.updates(spark, sf_dir)).withColumn("ingested_at", inputs.replay_clock())
    return comparable(build_fact(inputs.positions(spark, sf_dir), updates, 600, resent=True))


# --- bronze parse ----------------------------------------------------------------------------



def raw_message() -> Column:
    """Message text with numbers as text, fractions for integers, a key in the wrong case, an unknown
    key, and for error events something that is no JSON at all."""
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    fields = {
        "entity_id": F.col("event_id"),
        "feed_timestamp": F.when(kind == "signup", F.lit('"abc"')).otherwise(user),
        "trip_id": F.concat(F.lit('"'), user, F.lit('"')),
        "latitude": F.col("value"),
        "current_stop_sequence": F.when(kind == "purchase", F.lit("1.5")).otherwise(user),
        "STOP_ID": F.lit('"upper"'),
        "unknown": F.col("props"),
    }
    text = F.concat_ws(",", *(F.concat(F.lit(f'"{name}":'), value) for name, value in fields.items()))
    return F.when(kind == "error", F.lit("not json")).otherwise(F.concat(F.lit("{"), text, F.lit("}")))


@query(
    "bronze_json_parse",
    """select case when event_type <> 'error' then cast(event_id as varchar) end as entity_id,
      case when event_type not in ('error', 'signup') then user_id end as feed_timestamp,
      case when event_type <> 'error' then cast(user_id as varchar) end as trip_id,
      case when event_type <> 'error' then value end as latitude,
      case when event_type not in ('error', 'purchase') then cast(user_id as int) end as current_stop_sequence,
      cast(null as varchar) as stop_id
    from events""",
)
def _(spark, sf_dir):
    raw = inputs.table(spark, sf_dir, "events").select(raw_message().cast("binary").alias("value"))
    parsed = messages.decode(raw, VEHICLE_POSITION)
    return parsed.select("entity_id", "feed_timestamp", "trip_id", "latitude", "current_stop_sequence", "stop_id")


@query("json_round_trip", f"with {EVENTS_SQL} select {POSITION_NAMES} from vp")
def _(spark, sf_dir):
    return comparable(messages.decode(messages.encode(inputs.positions(spark, sf_dir)), VEHICLE_POSITION))


@query("bronze_trip_updates_parse", f"with {EVENTS_SQL} select {names(TRIP_UPDATE)}, ingested_at from tu")
def _(spark, sf_dir):
    parsed = messages.decode(messages.encode(inputs.updates(spark, sf_dir)), TRIP_UPDATE)
    return comparable(messages.stamp_ingest(parsed, inputs.replay_clock()))


# --- nested feeds ----------------------------------------------------------------------------


@query("feed_flatten_vehicle", inputs.FEED_VEHICLES_SQL)
def _(spark, sf_dir):
    return comparable(feed.vehicle_positions(inputs.snapshots(spark, sf_dir)))


@query("feed_flatten_trip_updates", inputs.FEED_UPDATES_SQL)
def _(spark, sf_dir):
    return comparable(feed.trip_updates(inputs.snapshots(spark, sf_dir)))


@query("feed_snapshot_files", inputs.FEED_VEHICLES_SQL)
def _(spark, sf_dir):
    """Snapshots written as JSON documents and read back before they are flattened."""
    path = run_dir(spark, "snapshots")
    inputs.snapshots(spark, sf_dir).write.json(path)
    return comparable(feed.vehicle_positions(read_snapshots(spark, path)))


@query(
    "poll_row_counts",
    f"with {EVENTS_SQL} select feed_timestamp, cast(count(*) as bigint) as record_count from vp group by 1",
)
def _(spark, sf_dir):
    return feed.poll_counts(inputs.positions(spark, sf_dir))


# --- dimensions ------------------------------------------------------------------------------


def static_dim(name: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Schedule file to bronze dimension."""
        path = run_dir(spark, f"schedule-{name}")
        inputs.schedule_files(spark, sf_dir)[name].write.options(header=True, escape='"').csv(path)
        rows = static.read_schedule_file(spark, path)
        return dims.static_dim(rows, STATIC_DIMS[name], LOAD_NUMBER)

    return build


for _name in STATIC_DIMS:
    query(f"static_dim_{_name}", inputs.SCHEDULE_SQL[_name])(static_dim(_name))


@query(
    "static_load_to_silver",
    " union all ".join(
        f"select '{name}' as dim, cast(count(*) as bigint) as row_count, "
        f"cast(count(distinct {key}) as bigint) as key_count from ({inputs.SCHEDULE_SQL[name]})"
        for name, key in (("route", "route_id"), ("stop", "stop_id"), ("trip", "trip_id"))
    )
    + f""" union all select 'vehicle', count(*), count(distinct vehicle_id) from (
      with {EVENTS_SQL} select distinct vehicle_id, vehicle_label, license_plate from cvp)""",
)
def _(spark, sf_dir):
    """Files to bronze to silver through the writing plans."""
    lake = run_dir(spark, "static")
    for name, rows in inputs.schedule_files(spark, sf_dir).items():
        rows.write.options(header=True, escape='"').csv(f"{lake}/files/{name}")
    write_table(inputs.positions(spark, sf_dir), f"{lake}/bronze/vehicle_positions")
    static.load_static(spark, f"{lake}/files", f"{lake}/bronze", LOAD_NUMBER, {name: name for name in STATIC_DIMS})
    static.write_silver_dims(spark, f"{lake}/bronze", f"{lake}/silver")
    counts = [
        read_table(spark, f"{lake}/silver/{name}").agg(
            F.lit(name).alias("dim"),
            F.count(F.lit(1)).alias("row_count"),
            F.countDistinct(f"{name}_id").alias("key_count"),
        )
        for name in ("route", "stop", "trip", "vehicle")
    ]
    return counts[0].union(counts[1]).union(counts[2]).union(counts[3])


def silver_dim(name: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        """One schedule file to bronze to silver, contents and not counts."""
        lake = run_dir(spark, f"silver-{name}")
        inputs.schedule_files(spark, sf_dir)[name].write.options(header=True, escape='"').csv(f"{lake}/files/{name}")
        rows = dims.static_dim(static.read_schedule_file(spark, f"{lake}/files/{name}"), STATIC_DIMS[name], LOAD_NUMBER)
        write_table(rows, f"{lake}/bronze/dim_{name}")
        static.write_silver_dim(spark, f"{lake}/bronze", f"{lake}/silver", name)
        return read_table(spark, f"{lake}/silver/{name}")

    return build


for _name in STATIC_DIMS:
    query(f"silver_dim_{_name}", inputs.SCHEDULE_SQL[_name])(silver_dim(_name))


@query("vehicle_dim", f"with {EVENTS_SQL} select distinct vehicle_id, vehicle_label, license_plate from cvp")
def _(spark, sf_dir):
    return dims.vehicle_dim(inputs.positions(spark, sf_dir))


@query(
    "vehicle_dim_latest",
    f"""with {EVENTS_SQL}, ranked as (
      select *, row_number() over (partition by vehicle_id order by vehicle_timestamp desc nulls last,
        vehicle_label desc nulls last, license_plate desc nulls last) as rank
      from cvp where vehicle_id is not null)
    select vehicle_id, vehicle_label, license_plate from ranked where rank = 1""",
)
def _(spark, sf_dir):
    return dims.latest_vehicles(inputs.positions(spark, sf_dir))


# --- declared star ---------------------------------------------------------------------------


@query(
    "dim_date",
    """with span as (select min(cast(o_orderdate as date)) as first, max(cast(o_orderdate as date)) as last from orders),
    days as (select cast(unnest(generate_series(first, last, interval 1 day)) as date) as date_id from span)
    select date_id, cast(isodow(date_id) as int) as day_of_week, isodow(date_id) >= 6 as is_weekend,
      date_id in (select cast(o_orderdate as date) from orders where o_totalprice > 450000) as is_holiday
    from days""",
)
def _(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders")
    day = F.col("o_orderdate")
    holidays = orders.filter("o_totalprice > 450000").select(day.cast("date").alias("date_id"))
    return warehouse.dim_date(F.min(day), F.max(day), orders, holidays)


def _stop_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.stop_delay(
        inputs.positions(spark, sf_dir),
        inputs.bronze_updates(spark, sf_dir),
        inputs.stop_times(spark, sf_dir),
        LOAD_NUMBER,
    )


_DELAY_COLUMNS = """vehicle_id, route_id, trip_id, stop_id, date_id, scheduled_arrival, estimated_arrival,
    actual_arrival, delay_seconds, avg_speed_segment, cast(null as varchar) as weather_condition"""


@query("stop_delay", f"{STOP_DELAY_SQL} select {_DELAY_COLUMNS}, '{LOAD_NUMBER}' as load_number from stop_delays")
def _(spark, sf_dir):
    # The surrogate key is a hash and the stamp a clock; neither has a counterpart to compare with.
    return comparable(_stop_delay(spark, sf_dir).drop("fact_id", "ingested_at"))


@query("stop_delay_incremental", f"{STOP_DELAY_SQL} select {_DELAY_COLUMNS} from stop_delays")
def _(spark, sf_dir):
    """Bronze arrives in three parts with a load after each; the second load's commit is as far as it comes."""
    lake = run_dir(spark, "incremental")
    positions, updates = inputs.positions(spark, sf_dir), inputs.bronze_updates(spark, sf_dir)
    times = inputs.stop_times(spark, sf_dir)
    part = F.pmod(F.xxhash64("entity_id"), F.lit(3))
    for i in range(3):
        write_table(positions.filter(part == i), f"{lake}/bronze/vehicle_positions", mode="append")
        write_table(updates.filter(part == i), f"{lake}/bronze/trip_updates", mode="append")
        if i == 1:
            incremental.DelayTable(spark, f"{lake}/star").take_in(f"{lake}/bronze", LOAD_NUMBER)
        else:
            incremental.load_delays(spark, f"{lake}/bronze", f"{lake}/star", times, LOAD_NUMBER, loads=2)
    rows = read_table(spark, f"{lake}/star/fact_stop_delay", columns=WAREHOUSE["fact_stop_delay"])
    return comparable(rows.drop("fact_id", "ingested_at", "load_number"))


@query(
    "fact_ids",
    f"""{STOP_DELAY_SQL} select cast(count(*) as bigint) as row_count, cast(count(distinct (start_date, route_id, trip_id,
      stop_id, vehicle_id)) as bigint) as id_count from visits""",
)
def _(spark, sf_dir):
    """The surrogate key is as distinct as the natural one."""
    rows = _stop_delay(spark, sf_dir)
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct("fact_id").alias("id_count"))


@query(
    "warehouse_build",
    f"""{STOP_DELAY_SQL}
    select 'dim_route' as name, route_id as id, route_short_name as detail from ({inputs.SCHEDULE_SQL['route']})
    union all select 'dim_stop', stop_id, stop_name from ({inputs.SCHEDULE_SQL['stop']})
    union all select 'dim_trip', trip_id, trip_headsign from ({inputs.SCHEDULE_SQL['trip']})
    union all select 'dim_vehicle', vehicle_id, null from (select distinct vehicle_id from cvp)
    union all select 'fact_stop_delay', concat_ws('/', vehicle_id, route_id, trip_id, stop_id, strftime(date_id, '%Y-%m-%d')),
      cast(delay_seconds as varchar) from stop_delays
    union all select 'audit_pipeline_runs', '6', null""",
)
def _(spark, sf_dir):
    """All star tables written by the plan and read back."""
    lake = run_dir(spark, "warehouse")
    write_table(inputs.positions(spark, sf_dir), f"{lake}/bronze/vehicle_positions")
    write_table(inputs.bronze_updates(spark, sf_dir), f"{lake}/bronze/trip_updates")
    for name, rows in inputs.schedule_files(spark, sf_dir).items():
        text = rows.select(*(F.col(c).cast("string").alias(c) for c in rows.columns))
        write_table(dims.static_dim(text, STATIC_DIMS[name], LOAD_NUMBER), f"{lake}/bronze/dim_{name}")
    warehouse.build_warehouse(
        spark, f"{lake}/bronze", f"{lake}/star", LOAD_NUMBER, stop_times=inputs.stop_times(spark, sf_dir)
    )

    def part(table: str, key: Column, detail: Column) -> DataFrame:
        rows = read_table(spark, f"{lake}/star/{table}")
        return rows.select(F.lit(table).alias("name"), key.alias("id"), detail.cast("string").alias("detail"))

    natural = F.concat_ws("/", "vehicle_id", "route_id", "trip_id", "stop_id", F.col("date_id").cast("string"))
    runs = read_table(spark, f"{lake}/star/audit_pipeline_runs").filter("status = 'SUCCESS'")
    audited = runs.agg(F.count(F.lit(1)).cast("string").alias("id"))
    return (
        part("dim_route", F.col("route_id"), F.col("route_short_name"))
        .union(part("dim_stop", F.col("stop_id"), F.col("stop_name")))
        .union(part("dim_trip", F.col("trip_id"), F.col("trip_headsign")))
        .union(part("dim_vehicle", F.col("vehicle_id"), F.lit(None)))
        .union(part("fact_stop_delay", natural, F.col("delay_seconds")))
        .union(audited.select(F.lit("audit_pipeline_runs"), "id", F.lit(None).cast("string")))
    )


@query(
    "segment_speed",
    f"""{STOP_DELAY_SQL} select start_date, route_id, trip_id, stop_id, vehicle_id, avg_speed_segment from visits""",
)
def _(spark, sf_dir):
    return warehouse.visits(inputs.positions(spark, sf_dir)).drop("actual_arrival")


STAR_SQL = f"""{STOP_DELAY_SQL}, newest as (
      select *, row_number() over (partition by vehicle_id order by vehicle_timestamp desc nulls last,
        vehicle_label desc nulls last, license_plate desc nulls last) as rank from cvp)
    select d.vehicle_id, d.route_id, d.trip_id, d.stop_id, d.date_id, d.actual_arrival, d.delay_seconds,
      v.license_plate, 'R' || n.n_nationkey is not null as known_route, n.n_name as route_short_name,
      c.c_mktsegment as trip_headsign, r.r_name as stop_name, cast(isodow(d.date_id) as int) as day_of_week
    from stop_delays d
    left join newest v on v.rank = 1 and d.vehicle_id = v.vehicle_id
    left join nation n on d.route_id = 'R' || n.n_nationkey
    left join customer c on d.trip_id = cast(c.c_custkey as varchar)
    left join region r on d.stop_id = 'S' || r.r_regionkey"""


def _star(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    positions = inputs.positions(spark, sf_dir)
    fact_rows = _stop_delay(spark, sf_dir).select(
        "vehicle_id", "route_id", "trip_id", "stop_id", "date_id", "actual_arrival", "delay_seconds"
    )
    day = F.to_date("start_date", "yyyyMMdd")
    derived = {
        "dim_vehicle": warehouse.dim_vehicle(positions, LOAD_NUMBER).select("vehicle_id", "license_plate"),
        "dim_date": warehouse.dim_date(F.min(day), F.max(day), positions).select("date_id", "day_of_week"),
    }
    lake = run_dir(spark, "star")
    for name, dim in derived.items():
        write_table(dim, f"{lake}/{name}")
    return fact_rows, inputs.star_dims(spark, sf_dir) | {name: read_table(spark, f"{lake}/{name}") for name in derived}


@query("star_lookup", STAR_SQL)
def _(spark, sf_dir):
    joined = warehouse.star_lookup(*_star(spark, sf_dir))
    known = F.col("route_short_name").isNotNull()
    return comparable(joined.withColumn("known_route", known))


BUCKETS = 8


@query("star_lookup_bucketed", STAR_SQL)
def _(spark, sf_dir):
    """Fact and trips stored in buckets by trip: the same lookup without a shuffle of the fact."""
    fact_rows, dims_ = _star(spark, sf_dir)
    lake = run_dir(spark, "buckets")
    database = "buckets_" + lake.rpartition("-")[2]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{lake}'")
    warehouse.store_bucketed(fact_rows, f"{database}.fact_stop_delay", "trip_id", BUCKETS)
    warehouse.store_bucketed(dims_["dim_trip"], f"{database}.dim_trip", "trip_id", BUCKETS)
    star = dims_ | {"dim_trip": spark.table(f"{database}.dim_trip")}
    joined = warehouse.bucketed_lookup(spark.table(f"{database}.fact_stop_delay"), star, "trip_id")
    return comparable(joined.withColumn("known_route", F.col("route_short_name").isNotNull()))


@query("fact_for_filters", f"{STOP_DELAY_SQL} select {_DELAY_COLUMNS} from stop_delays")
def _(spark, sf_dir):
    """The fact laid out along a curve over route and date, and read back."""
    lake = run_dir(spark, "layout")
    write_table(_stop_delay(spark, sf_dir), f"{lake}/fact")
    warehouse.save_for_filters(read_table(spark, f"{lake}/fact"), f"{lake}/laid_out", rows_per_file=1000)
    return comparable(read_table(spark, f"{lake}/laid_out").drop("fact_id", "ingested_at", "load_number"))


@query(
    "star_dims",
    f"""select 'dim_route' as dim, route_id as id, load_number, created_at from (
      select *, timestamp '2024-02-01 00:00:00' as created_at from ({inputs.SCHEDULE_SQL['route']}))
    union all select 'dim_stop', stop_id, load_number, timestamp '2024-02-01 00:00:00' from ({inputs.SCHEDULE_SQL['stop']})
    union all select 'dim_trip', trip_id, load_number, timestamp '2024-02-01 00:00:00' from ({inputs.SCHEDULE_SQL['trip']})
    """,
)
def _(spark, sf_dir):
    stamp = F.timestamp_seconds(F.lit(1706745600))
    stacked = None
    for name, rows in inputs.schedule_files(spark, sf_dir).items():
        text = rows.select(*(F.col(c).cast("string").alias(c) for c in rows.columns))
        dim = warehouse.star_dim(dims.static_dim(text, STATIC_DIMS[name], LOAD_NUMBER), f"dim_{name}", stamp)
        part = dim.select(
            F.lit(f"dim_{name}").alias("dim"), F.col(f"{name}_id").alias("id"), "load_number", "created_at"
        )
        stacked = part if stacked is None else stacked.union(part)
    return comparable(stacked)


# Three loads of the stops: some come late, some are gone for a load, some change their name.
HISTORY_SQL = """
with loads(l) as (values (1), (2), (3)),
states as (
  select c_custkey as k, l, case l when 1 then c_custkey % 7 <> 0 when 2 then c_custkey % 5 <> 0 else true end as here,
    case when l > 1 and c_custkey % 3 = 0 then c_name || '!' else c_name end as name
  from customer, loads),
before as (select *, lag(here) over (partition by k order by l) as was, lag(name) over (partition by k order by l) as old from states),
changes as (
  select k, l, here, name, lead(l) over (partition by k order by l) as until
  from before where was is null or here <> was or (here and name <> old)),
first as (select k, min(l) as l from states where here group by 1)
select cast(c.k as varchar) as stop_id, c.name as stop_name, make_timestamp(first.l * 1000000) as created_at,
  make_timestamp(c.l * 1000000) as updated_at, make_timestamp(c.l * 1000000) as valid_from,
  make_timestamp(c.until * 1000000) as valid_to, 'load' || c.l as load_number
from changes c join first on c.k = first.k where c.here"""


def _stop_loads(spark: SparkSession, sf_dir: str) -> DimensionTable:
    stops, key = inputs.table(spark, sf_dir, "customer"), F.col("c_custkey")
    dim = DimensionTable(spark, run_dir(spark, "history"), "dim_stop")
    for load, here in ((1, key % 7 != 0), (2, key % 5 != 0), (3, F.lit(True))):
        name = F.when((key % 3 == 0) & F.lit(load > 1), F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name"))
        rows = stops.filter(here).select(key.cast("string").alias("stop_id"), name.alias("stop_name"))
        stamp = F.timestamp_seconds(F.lit(load))
        dim.merge(rows, f"load{load}", stamp)
        dim.merge(rows, f"load{load}", stamp)  # run again by mistake
    return dim


@query("dim_history", HISTORY_SQL)
def _(spark, sf_dir):
    rows = _stop_loads(spark, sf_dir).history()
    return comparable(
        rows.select("stop_id", "stop_name", "created_at", "updated_at", "valid_from", "valid_to", "load_number")
    )


@query("dim_history_current", f"select stop_id, stop_name, created_at, load_number from ({HISTORY_SQL}) where valid_to is null")
def _(spark, sf_dir):
    return comparable(_stop_loads(spark, sf_dir).current().select("stop_id", "stop_name", "created_at", "load_number"))


@query(
    "pk_violations",
    """select l_orderkey, l_linenumber, cast(count(*) as bigint) as row_count
    from lineitem group by 1, 2 having count(*) > 1""",
)
def _(spark, sf_dir):
    return quality.pk_violations(inputs.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "fk_orphans",
    f"""with {EVENTS_SQL} select stop_id, cast(count(*) as bigint) as row_count from cvp
    where stop_id not in (select 'S' || r_regionkey from region) group by 1""",
)
def _(spark, sf_dir):
    usable = clean_positions(inputs.positions(spark, sf_dir))
    return quality.fk_orphans(usable, "stop_id", inputs.star_dims(spark, sf_dir)["dim_stop"])


# Two loads: the first brings facts of even trips and stops up to S4, the second the other facts and stops up to S7.
LATE_PARENTS_SQL = f"""{STOP_DELAY_SQL}, placed as (
  select *, cast(substr(stop_id, 2) as int) as stop, cast(trip_id as bigint) % 2 as later from stop_delays)"""


def _late_stops(spark: SparkSession, sf_dir: str, most: int) -> DataFrame:
    number = F.col("n_nationkey")
    stops = inputs.table(spark, sf_dir, "nation").filter(number <= most)
    return stops.select(F.concat(F.lit("S"), number).alias("stop_id"), F.col("n_name").alias("stop_name"))


def _held_facts(spark: SparkSession, sf_dir: str) -> HeldFacts:
    lake = run_dir(spark, "late-parents")
    write_table(_stop_delay(spark, sf_dir), f"{lake}/fact")
    fact_rows, held = read_table(spark, f"{lake}/fact"), HeldFacts(spark, f"{lake}/held")
    dims = {name: rows for name, rows in inputs.star_dims(spark, sf_dir).items() if name == "dim_route"}
    for load, most in enumerate((4, 7)):
        rows = fact_rows.filter(F.pmod(F.col("trip_id").cast("bigint"), F.lit(2)) == load)
        for _ in range(2):  # the second time by mistake
            held.load(rows, dims | {"dim_stop": _late_stops(spark, sf_dir, most)}, f"load{load + 1}")
    return held


@query(
    "late_parents",
    f"""{LATE_PARENTS_SQL} select {_DELAY_COLUMNS}, 'stop_id' as missing, 'load' || (later + 1) as load from placed where stop > 7
    union all select {_DELAY_COLUMNS}, '', case when stop > 4 or later = 1 then 'load2' else 'load1' end from placed where stop <= 7""",
)
def _(spark, sf_dir):
    """Facts wait for their stop; what the second load resolves passes then, the rest still waits."""
    held = _held_facts(spark, sf_dir)
    waits = held.held().withColumns({"missing": F.array_join("missing", ","), "load": F.col("held_since")})
    passed = held.passed().withColumns({"missing": F.lit(""), "load": F.col("passed_in")})
    both = waits.drop("held_since").unionByName(passed.drop("passed_in"))
    return comparable(both.drop("fact_id", "ingested_at", "load_number"))


@query(
    "inferred_members",
    f"""with {EVENTS_SQL}, orphans as (select distinct stop_id from cvp where cast(substr(stop_id, 2) as int) > 4)
    select 'S' || n_nationkey as stop_id, n_name as stop_name,
      make_timestamp(case when n_nationkey in (select cast(substr(stop_id, 2) as int) from orphans) then 2000000
        when n_nationkey > 4 then 3000000 else 1000000 end) as created_at,
      case when n_nationkey > 4 then 'load2' else 'load1' end as load_number from nation where n_nationkey <= 7
    union all select stop_id, null, make_timestamp(2000000), 'load1-inferred' from orphans
      where cast(substr(stop_id, 2) as int) > 7""",
)
def _(spark, sf_dir):
    """Stops that positions refer to before they are known get a row of their key alone, until they come."""
    dim, at = DimensionTable(spark, run_dir(spark, "inferred"), "dim_stop"), lambda n: F.timestamp_seconds(F.lit(n))
    dim.merge(_late_stops(spark, sf_dir, 4), "load1", at(1), complete=False)
    infer_members(dim, clean_positions(inputs.positions(spark, sf_dir)), "load1", at(2))
    dim.merge(_late_stops(spark, sf_dir, 7), "load2", at(3), complete=False)
    return comparable(dim.current().select("stop_id", "stop_name", "created_at", "load_number"))


@query(
    "audit_run",
    f"""with {EVENTS_SQL} select '{LOAD_NUMBER}' as load_number, 'silver.positions' as layer, 'SUCCESS' as status,
      cast(count(*) as bigint) as row_count from cvp
    union all select '{LOAD_NUMBER}', 'silver.updates', 'SUCCESS', count(*) from ctu""",
)
def _(spark, sf_dir):
    lake = run_dir(spark, "audit")
    tables = {
        "positions": clean_positions(inputs.positions(spark, sf_dir)),
        "updates": clean_updates(inputs.bronze_updates(spark, sf_dir)),
    }
    runs = []
    for name, rows in tables.items():
        run = audit.AuditedRun(LOAD_NUMBER, f"silver.{name}")
        run.write(rows, lambda counted, name=name: write_table(counted, f"{lake}/{name}"))
        runs.append(run)
    # Clock columns and the key made from them differ between runs.
    return audit.audit_rows(spark, runs).drop("run_id", "start_time", "end_time")


# --- streams ---------------------------------------------------------------------------------

FLUSH_TRIP = "~flush"
FLUSH_SECOND = 4_102_444_800


class StreamRun:
    """The streaming pipeline over staged topics, every query run until its input is drained."""

    def __init__(self, spark: SparkSession, sf_dir: str, name: str) -> None:
        self.spark = stream_session(spark)
        self.lake = run_dir(spark, name)
        self.sf_dir = sf_dir

    def send(self, positions: DataFrame, updates: DataFrame) -> None:
        write_topic(messages.encode(positions), f"{self.lake}/topics/positions", "parquet")
        write_topic(messages.encode(updates), f"{self.lake}/topics/updates", "parquet")

    def send_events(self) -> None:
        self.send(inputs.positions(self.spark, self.sf_dir), inputs.updates(self.spark, self.sf_dir))

    def send_flush(self) -> None:
        """Far-future rows on both sides, whose keys match nothing, to move both watermarks."""
        keys = {name: FLUSH_TRIP for name in JOIN_KEYS}
        second = F.lit(FLUSH_SECOND).cast("bigint")

        def row(columns: dict[str, str], **values) -> DataFrame:
            return self.spark.range(1).select(
                *(values.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in columns.items())
            )

        left = {name: F.lit(f"{value}-left") for name, value in keys.items()}
        right = {name: F.lit(f"{value}-right") for name, value in keys.items()}
        self.send(
            row(VEHICLE_POSITION, feed_timestamp=second, vehicle_timestamp=second, **left),
            row(TRIP_UPDATE, feed_timestamp=second, **right),
        )

    def bronze(self) -> None:
        running = [
            jobs.bronze_positions(
                self.spark,
                f"{self.lake}/topics/positions",
                f"{self.lake}/bronze/vehicle_positions",
                f"{self.lake}/checkpoints/positions",
                topic_fmt="parquet",
                trigger=UNTIL_DRAINED,
            ),
            jobs.bronze_updates(
                self.spark,
                f"{self.lake}/topics/updates",
                f"{self.lake}/bronze/trip_updates",
                f"{self.lake}/checkpoints/updates",
                topic_fmt="parquet",
                trigger=UNTIL_DRAINED,
                ingest_clock=inputs.replay_clock(),
            ),
        ]
        for running_query in running:
            running_query.awaitTermination()

    def fact(self, bound: int, rows_per_task: int, resent: bool = False) -> None:
        jobs.silver_fact(
            self.spark,
            f"{self.lake}/bronze/vehicle_positions",
            f"{self.lake}/bronze/trip_updates",
            f"{self.lake}/silver/fact",
            f"{self.lake}/checkpoints/fact",
            trigger=UNTIL_DRAINED,
            bound=bound,
            rows_per_task=rows_per_task,
            resent=resent,
        ).awaitTermination()


@query("stream_bronze_vehicle_positions", f"with {EVENTS_SQL} select {POSITION_NAMES} from vp")
def _(spark, sf_dir):
    run = StreamRun(spark, sf_dir, "stream-bronze")
    run.send_events()
    run.bronze()
    return comparable(read_table(spark, f"{run.lake}/bronze/vehicle_positions"))


@query("stream_bronze_trip_updates", f"with {EVENTS_SQL} select {names(TRIP_UPDATE)}, ingested_at from tu")
def _(spark, sf_dir):
    run = StreamRun(spark, sf_dir, "stream-bronze")
    run.send_events()
    run.bronze()
    return comparable(read_table(spark, f"{run.lake}/bronze/trip_updates"))


def stream_fact(bound: int, rows_per_task: int = ROWS_PER_TASK) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Topics to bronze to fact, then once more with rows that flush the unmatched positions."""
        run = StreamRun(spark, sf_dir, "stream-fact")
        run.send_events()
        run.bronze()
        run.fact(bound, rows_per_task)
        run.send_flush()
        run.bronze()
        run.fact(bound, rows_per_task)
        rows = read_table(spark, f"{run.lake}/silver/fact")
        return comparable(rows.filter(~F.col("trip_id").startswith(FLUSH_TRIP)))

    return build


query("stream_fact_10m", fact_sql(600, timeless=False))(stream_fact(600))
query("stream_fact_6h", fact_sql(SIX_HOURS, timeless=False))(stream_fact(SIX_HOURS))
query("stream_fact_6h_split", fact_sql(SIX_HOURS, timeless=False))(stream_fact(SIX_HOURS, rows_per_task=8))


@query("stream_late_rows", fact_sql(600, timeless=False))
def _(spark, sf_dir):
    """Rows that come after the watermark has passed them leave no trace."""
    run = StreamRun(spark, sf_dir, "stream-late")
    run.send_events()
    run.bronze()
    run.fact(600, ROWS_PER_TASK)
    old = F.lit(10 * 365 * 86_400)
    late = inputs.positions(run.spark, sf_dir).withColumn("vehicle_timestamp", F.col("vehicle_timestamp") - old)
    late_updates = inputs.updates(run.spark, sf_dir).withColumn("feed_timestamp", F.col("feed_timestamp") - old)
    run.send(late, late_updates)
    run.send_flush()
    run.bronze()
    run.fact(600, ROWS_PER_TASK)
    rows = read_table(spark, f"{run.lake}/silver/fact")
    return comparable(rows.filter(~F.col("trip_id").startswith(FLUSH_TRIP)))


@query("stream_fact_resent", f"select * from ({RESENT_SQL}) where vehicle_timestamp is not null")
def _(spark, sf_dir):
    """Polls of equal updates are one row of the join's state."""
    run = StreamRun(spark, sf_dir, "stream-resent")
    run.send(inputs.positions(run.spark, sf_dir), _polls(inputs.updates(run.spark, sf_dir)))
    for _ in range(2):
        run.bronze()
        run.fact(600, ROWS_PER_TASK, resent=True)
        run.send_flush()
    rows = read_table(spark, f"{run.lake}/silver/fact")
    return comparable(rows.filter(~F.col("trip_id").startswith(FLUSH_TRIP)))


@query(
    "stream_state_waiting",
    f"""with {EVENTS_SQL},
    waits as (
      select least((select max(cvp.at) from cvp), (select max(ingested_at) from ctu)) - interval 900 second as since),
    held as (
      select 'left' as side, trip_id, route_id, stop_id from cvp, waits where cvp.at >= since
      union all select 'right', trip_id, route_id, stop_id from ctu, waits where ingested_at >= since)
    select 'before' as flush, side, cast(count(*) as bigint) as row_count,
      cast(count(distinct (trip_id, route_id, stop_id)) as bigint) as key_count from held group by side""",
)
def _(spark, sf_dir):
    """What the join holds when the input is drained, read from its checkpoint; after a flush, nothing."""
    run = StreamRun(spark, sf_dir, "stream-state")
    run.send_events()
    reports = []
    for flush in ("before", "after"):
        run.bronze()
        run.fact(600, ROWS_PER_TASK)
        held = state.waiting_rows(run.spark, f"{run.lake}/checkpoints/fact").filter(~F.col("trip_id").startswith(FLUSH_TRIP))
        counts = held.groupBy(F.lit(flush).alias("flush"), "side").agg(
            F.count(F.lit(1)).alias("row_count"), F.countDistinct(*JOIN_KEYS).alias("key_count")
        )
        write_table(counts, f"{run.lake}/report/{flush}")
        reports.append(read_table(spark, f"{run.lake}/report/{flush}"))
        run.send_flush()
    return reports[0].unionByName(reports[1])


@query("stream_fact_hot_later", fact_sql(SIX_HOURS, timeless=False))
def _(spark, sf_dir):
    """The first day is quiet; keys that the later days make hot are split when the stream starts again."""
    run = StreamRun(spark, sf_dir, "stream-hot")
    day = inputs.table(spark, sf_dir, "events").agg(F.min("ts").cast("date")).first()[0] + timedelta(days=1)
    early = F.col("start_date") <= day.strftime("%Y%m%d")
    positions, updates = inputs.positions(run.spark, sf_dir), inputs.updates(run.spark, sf_dir)
    for later in (False, True, None):
        if later is None:
            run.send_flush()
        else:
            run.send(*(rows.filter(~early if later else early) for rows in (positions, updates)))
        run.bronze()
        adaptive.silver_fact_adaptive(
            run.spark,
            f"{run.lake}/bronze/vehicle_positions",
            f"{run.lake}/bronze/trip_updates",
            f"{run.lake}/silver/fact",
            f"{run.lake}/checkpoints/fact",
            UNTIL_DRAINED,
            SIX_HOURS,
            rows_per_task=4,
        ).awaitTermination()
    rows = read_table(spark, f"{run.lake}/silver/fact")
    return comparable(rows.filter(~F.col("trip_id").startswith(FLUSH_TRIP)))


LATE_SECONDS = 10 * 365 * 86_400


def _late_run(spark: SparkSession, sf_dir: str) -> StreamRun:
    """All rows once in time, then once more ten years too late for the watermark."""
    run = StreamRun(spark, sf_dir, "stream-repair")
    run.send_events()
    run.bronze()
    run.fact(600, ROWS_PER_TASK)
    late = inputs.positions(run.spark, sf_dir).withColumn("vehicle_timestamp", F.col("vehicle_timestamp") - LATE_SECONDS)
    late_updates = inputs.updates(run.spark, sf_dir).withColumn("feed_timestamp", F.col("feed_timestamp") - LATE_SECONDS)
    run.send(late, late_updates)
    run.send_flush()
    run.bronze()
    run.fact(600, ROWS_PER_TASK)
    return run


# The batch join of both sendings; late positions without a time are those of the first once more.
LATE_SQL = f"""with {EVENTS_SQL},
  both_p as (select *, cvp.at as t from cvp union all select *, cvp.at - interval {LATE_SECONDS} second from cvp),
  both_u as (select *, ingested_at as t from ctu union all select *, ingested_at - interval {LATE_SECONDS} second from ctu),
  expected as (
    select p.trip_id, p.route_id, p.stop_id, p.vehicle_id, p.latitude, p.longitude,
      cast(p.speed as double) as speed, cast(p.bearing as double) as bearing, p.current_status,
      p.t as vehicle_timestamp, u.arrival_time, u.departure_time, u.arrival_uncertainty, u.t as ingested_at
    from both_p p left join both_u u on p.trip_id = u.trip_id and p.route_id = u.route_id and p.stop_id = u.stop_id
      and u.t between p.t - interval 600 second and p.t + interval 600 second)"""


@query("stream_late_repaired", f"{LATE_SQL} select * from expected")
def _(spark, sf_dir):
    """The windows that the stream lost are found and joined again; read with them it is the batch join."""
    run = _late_run(spark, sf_dir)
    fact = RepairedFact(spark, f"{run.lake}/silver")
    fact.repair(f"{run.lake}/bronze", 600)
    return comparable(fact.read().filter(~F.col("trip_id").startswith(FLUSH_TRIP)))


@query(
    "stream_lost_windows",
    f"""{LATE_SQL}
    select epoch_us(vehicle_timestamp) // 3600000000 as hour_no, cast(count(*) as bigint) as lost_rows
    from expected where vehicle_timestamp is null or vehicle_timestamp < (select date_trunc('hour', min(ts)) from events) group by 1""",
)
def _(spark, sf_dir):
    """How many rows each window lacks, by accounts alone; null are positions without a time."""
    run = _late_run(spark, sf_dir)
    lost = RepairedFact(spark, f"{run.lake}/silver").lost(f"{run.lake}/bronze", 600)
    lost = lost.filter(F.col("window") < FLUSH_SECOND // 3600)  # what flushes is itself still to be emitted
    hour = F.nullif(F.col("window"), F.lit(NO_TIME)).alias("hour_no")
    return lost.groupBy(hour).agg(F.sum(F.col("expected_rows") - F.col("given_rows")).alias("lost_rows"))


def stream_publish(part: str, columns: dict[str, str]) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Snapshot files arrive, are flattened and published; the topic is then read back."""
        lake = run_dir(spark, "stream-publish")
        inputs.snapshots(spark, sf_dir).write.json(f"{lake}/snapshots")
        jobs.publish_feed(
            stream_session(spark),
            f"{lake}/snapshots",
            part,
            f"{lake}/topic",
            f"{lake}/checkpoint",
            fmt="parquet",
            trigger=UNTIL_DRAINED,
        ).awaitTermination()
        return comparable(messages.decode(read_table(spark, f"{lake}/topic"), columns))

    return build


query("stream_publish_vehicle_positions", inputs.FEED_VEHICLES_SQL)(
    stream_publish("vehicle_positions", VEHICLE_POSITION)
)
query("stream_publish_trip_updates", inputs.FEED_UPDATES_SQL)(stream_publish("trip_updates", TRIP_UPDATE))
