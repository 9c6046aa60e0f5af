"""Transit inputs derived from the given tables, each as a DataFrame and as SQL for the comparison.

Every event is either a vehicle position (click, view, error) or a trip update (purchase, signup).
The number in ``props`` decides which rows get blank keys, unknown times and other odd values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.schemas import TRIP_UPDATE, VEHICLE_POSITION

LOAD_NUMBER = "20240131_120000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _odd(k: int, value: object) -> Column:
    return F.when(F.col("k") == k, F.lit(value))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    second = F.unix_seconds(F.col("ts").cast("timestamp"))
    # The one number in props; the key filter looks at it many times, so it is cut out, not parsed.
    number = F.substring_index(F.substring_index("props", ":", -1), "}", 1).cast("int")
    user = F.col("user_id")
    return (
        table(spark, sf_dir, "events")
        .withColumns({"second": second, "k": number})
        .withColumns(
            {
                "entity_id": F.col("event_id").cast("string"),
                "feed_timestamp": F.col("second") - F.pmod("second", F.lit(15)),
                "trip_id": _odd(0, "").when(F.col("k") == 1, F.lit(None)).when(F.col("k") == 2, F.lit("   "))
                .otherwise(user.cast("string")),
                "route_id": _odd(5, "").otherwise(F.concat(F.lit("R"), F.pmod(user, F.lit(25)))),
                "stop_id": _odd(6, None).otherwise(F.concat(F.lit("S"), F.pmod(user, F.lit(10)))),
                "start_date": F.date_format("ts", "yyyyMMdd"),
                "schedule_relationship": F.lit("SCHEDULED"),
            }
        )
    )


EVENTS_SQL = """
ev as (
  select *, epoch_us(ts) // 1000000 as sec, cast(props->>'$.k' as int) as k from events),
keyed as (
  select *, cast(event_id as varchar) as entity_id, sec - sec % 15 as feed_timestamp,
    case k when 0 then '' when 1 then null when 2 then '   ' else cast(user_id as varchar) end as trip_id,
    case k when 5 then '' else 'R' || (user_id % 25) end as route_id,
    case k when 6 then null else 'S' || (user_id % 10) end as stop_id,
    strftime(ts, '%Y%m%d') as start_date, 'SCHEDULED' as schedule_relationship
  from ev),
vp as (
  select entity_id, feed_timestamp, trip_id, route_id, start_date, schedule_relationship,
    value as latitude, -value / 2 as longitude,
    cast(value as float) as bearing, cast(floor(value) as float) as speed,
    k as current_stop_sequence,
    case event_type when 'click' then 'STOPPED_AT' when 'view' then 'IN_TRANSIT_TO' end as current_status,
    stop_id, case k when 3 then null else sec end as vehicle_timestamp,
    'V' || (user_id % 40) as vehicle_id,
    case event_type when 'error' then null else 'L' || (user_id % 80) end as vehicle_label,
    case when k < 50 then 'P' || (user_id % 40) else '' end as license_plate
  from keyed where event_type in ('click', 'view', 'error')),
tu as (
  select entity_id, feed_timestamp, trip_id, route_id, start_date, schedule_relationship,
    k as stop_sequence, stop_id,
    case k when 7 then 0 when 8 then null else sec + cast(floor(value) as bigint) end as arrival_time,
    k as arrival_uncertainty,
    case k when 9 then null else sec + cast(floor(value) as bigint) + 30 end as departure_time,
    make_timestamp(feed_timestamp * 1000000) as ingested_at
  from keyed where event_type in ('purchase', 'signup')),
cvp as (
  select *, make_timestamp(vehicle_timestamp * 1000000) as at from vp
  where trim(trip_id) <> '' and trim(route_id) <> '' and trim(stop_id) <> ''),
ctu as (
  select * from tu where trim(trip_id) <> '' and trim(route_id) <> '' and trim(stop_id) <> '')
"""


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    user = F.col("user_id")
    kind = F.col("event_type")
    return (
        _events(spark, sf_dir)
        .filter(kind.isin("click", "view", "error"))
        .withColumns(
            {
                "latitude": value,
                "longitude": -value / 2,
                "bearing": value.cast("float"),
                "speed": F.floor(value).cast("float"),
                "current_stop_sequence": F.col("k"),
                "current_status": F.when(kind == "click", "STOPPED_AT").when(kind == "view", "IN_TRANSIT_TO"),
                "vehicle_timestamp": _odd(3, None).otherwise(F.col("second")),
                "vehicle_id": F.concat(F.lit("V"), F.pmod(user, F.lit(40))),
                "vehicle_label": F.when(kind != "error", F.concat(F.lit("L"), F.pmod(user, F.lit(80)))),
                "license_plate": F.when(F.col("k") < 50, F.concat(F.lit("P"), F.pmod(user, F.lit(40)))).otherwise(""),
            }
        )
        .select(*VEHICLE_POSITION)
    )


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip updates as sent, without an ingest time."""
    predicted = F.col("second") + F.floor("value")
    return (
        _events(spark, sf_dir)
        .filter(F.col("event_type").isin("purchase", "signup"))
        .withColumns(
            {
                "stop_sequence": F.col("k"),
                "arrival_time": _odd(7, 0).when(F.col("k") == 8, F.lit(None)).otherwise(predicted),
                "arrival_uncertainty": F.col("k"),
                "departure_time": _odd(9, None).otherwise(predicted + 30),
            }
        )
        .select(*TRIP_UPDATE)
    )


def replay_clock() -> Column:
    """Repeatable ingest time: the feed's own."""
    return F.timestamp_seconds("feed_timestamp")


def bronze_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return updates(spark, sf_dir).withColumn("ingested_at", replay_clock())


# Nested feeds: one snapshot per order with a vehicle, a trip update and an alert-like entity
# that carries neither. Order status and priority decide which parts are absent or unset.


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    price = F.col("o_totalprice")
    trip = F.when(
        status != "P",
        F.struct(
            key.cast("string").alias("trip_id"),
            F.when(status != "F", customer.cast("string")).alias("route_id"),
            F.date_format("o_orderdate", "yyyyMMdd").alias("start_date"),
            F.when(priority != "1-URGENT", F.pmod(customer, F.lit(10)).cast("int")).alias("schedule_relationship"),
        ),
    )
    position = F.when(
        priority != "2-HIGH",
        F.struct(
            (price / 10000).cast("float").alias("latitude"),
            (price / -7000).cast("float").alias("longitude"),
            F.when(status != "O", (price / 3000).cast("float")).alias("bearing"),
            (price / 9000).cast("float").alias("speed"),
        ),
    )
    descriptor = F.when(
        priority != "3-MEDIUM",
        F.struct(
            F.concat(F.lit("V"), customer).alias("id"),
            F.when(status != "F", F.lit("label")).alias("label"),
            F.lit(None).cast("string").alias("license_plate"),
        ),
    )
    vehicle = F.when(
        priority != "5-LOW",
        F.struct(
            trip.alias("trip"),
            position.alias("position"),
            F.when(status != "F", F.pmod(key, F.lit(50)).cast("int")).alias("current_stop_sequence"),
            F.when(status != "O", F.pmod(customer, F.lit(4)).cast("int")).alias("current_status"),
            F.when(status != "F", F.concat(F.lit("S"), customer)).alias("stop_id"),
            F.when(status != "O", F.unix_seconds(F.col("o_orderdate").cast("timestamp"))).alias("timestamp"),
            descriptor.alias("vehicle"),
        ),
    )
    due = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))

    def stop(i: int) -> Column:
        arrival = F.struct((due + i if i != 3 else F.lit(None).cast("bigint")).alias("time"), F.lit(60).alias("uncertainty"))
        departure = F.struct((due + i * 2).alias("time"), F.lit(None).cast("int").alias("uncertainty"))
        return F.struct(
            F.when(status != "F", F.lit(i)).alias("stop_sequence"),
            F.concat(F.lit("S"), customer + i).alias("stop_id"),
            F.when(F.lit(i != 2), arrival).alias("arrival"),
            F.when(F.lit(i != 1), departure).alias("departure"),
        )

    # From four stops for an urgent order down to none for a low one.
    stop_count = 5 - F.substring("o_orderpriority", 1, 1).cast("int")
    stops = F.slice(F.array(*map(stop, (1, 2, 3, 4))), 1, stop_count)
    update = F.struct(trip.alias("trip"), stops.alias("stop_time_update"))
    entity = F.array(
        F.struct(
            F.concat(F.lit("v"), key).alias("id"),
            vehicle.alias("vehicle"),
            F.when(F.lit(False), update).alias("trip_update"),
        ),
        F.struct(
            F.concat(F.lit("t"), key).alias("id"),
            F.when(F.lit(False), vehicle).alias("vehicle"),
            update.alias("trip_update"),
        ),
        F.struct(
            F.concat(F.lit("a"), key).alias("id"),
            F.when(F.lit(False), vehicle).alias("vehicle"),
            F.when(F.lit(False), update).alias("trip_update"),
        ),
    )
    orders = table(spark, sf_dir, "orders")
    return orders.select(F.struct(due.alias("timestamp")).alias("header"), entity.alias("entity"))


_RELATIONSHIP_SQL = """case when o_orderstatus = 'P' then null when o_orderpriority = '1-URGENT' then 'SCHEDULED' else
    case o_custkey % 10 when 0 then 'SCHEDULED' when 1 then 'ADDED' when 2 then 'UNSCHEDULED' when 3 then 'CANCELED'
      when 5 then 'REPLACEMENT' when 6 then 'DUPLICATED' when 7 then 'DELETED' when 8 then 'NEW' end end"""

_FEED_TRIP_SQL = f"""
  case when o_orderstatus <> 'P' then cast(o_orderkey as varchar) end as trip_id,
  case o_orderstatus when 'P' then null when 'F' then '' else cast(o_custkey as varchar) end as route_id,
  case when o_orderstatus <> 'P' then strftime(o_orderdate, '%Y%m%d') end as start_date,
  {_RELATIONSHIP_SQL} as schedule_relationship"""

FEED_VEHICLES_SQL = f"""
select 'v' || o_orderkey as entity_id, epoch_us(o_orderdate) // 1000000 as feed_timestamp, {_FEED_TRIP_SQL},
  case when o_orderpriority <> '2-HIGH' then cast(cast(o_totalprice / 10000 as float) as double) end as latitude,
  case when o_orderpriority <> '2-HIGH' then cast(cast(o_totalprice / -7000 as float) as double) end as longitude,
  case when o_orderpriority <> '2-HIGH' then
    case when o_orderstatus = 'O' then 0.0 else cast(cast(o_totalprice / 3000 as float) as double) end end as bearing,
  case when o_orderpriority <> '2-HIGH' then cast(cast(o_totalprice / 9000 as float) as double) end as speed,
  case when o_orderstatus <> 'F' then cast(o_orderkey % 50 as int) end as current_stop_sequence,
  case when o_orderstatus <> 'O' then
    case o_custkey % 4 when 0 then 'INCOMING_AT' when 1 then 'STOPPED_AT' when 2 then 'IN_TRANSIT_TO' end
  end as current_status,
  case when o_orderstatus <> 'F' then 'S' || o_custkey end as stop_id,
  case when o_orderstatus <> 'O' then epoch_us(o_orderdate) // 1000000 end as vehicle_timestamp,
  case when o_orderpriority <> '3-MEDIUM' then 'V' || o_custkey end as vehicle_id,
  case when o_orderpriority <> '3-MEDIUM' then
    case when o_orderstatus = 'F' then '' else 'label' end end as vehicle_label,
  case when o_orderpriority <> '3-MEDIUM' then '' end as license_plate
from orders where o_orderpriority <> '5-LOW'"""

FEED_UPDATES_SQL = f"""
select 't' || o_orderkey as entity_id, epoch_us(o_orderdate) // 1000000 as feed_timestamp, {_FEED_TRIP_SQL},
  case when o_orderstatus <> 'F' then cast(i as int) end as stop_sequence,
  'S' || (o_custkey + i) as stop_id,
  case i when 2 then null when 3 then 0 else epoch_us(o_orderdate) // 1000000 + i end as arrival_time,
  case when i <> 2 then cast(60 as int) end as arrival_uncertainty,
  case when i <> 1 then epoch_us(o_orderdate) // 1000000 + i * 2 end as departure_time
from orders, (values (1), (2), (3), (4)) as stops(i)
where i <= 5 - cast(left(o_orderpriority, 1) as int)"""


# Schedule files: routes from parts, stops from customers, trips from orders; as in real files,
# columns come in another order, with columns nobody asked for, quotes, and text where numbers belong.


def schedule_files(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    part = table(spark, sf_dir, "part")
    customer = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    return {
        "route": part.select(
            F.lit("agency").alias("agency_id"),
            F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("route_id"),
            F.col("p_type").alias("route_desc"),
            F.col("p_brand").alias("route_short_name"),
            F.concat(F.lit('the "'), "p_name", F.lit('", line')).alias("route_long_name"),
            F.col("p_size").alias("route_type"),
            F.when(F.col("p_size") > 25, F.lit("00FF00")).alias("route_color"),
        ),
        "stop": customer.select(
            F.col("c_mktsegment").alias("stop_code"),
            F.col("c_acctbal").alias("stop_lat"),
            (F.col("c_acctbal") / 3).alias("stop_lon"),
            F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("stop_name"),
            F.col("c_custkey").alias("stop_id"),
            F.when(F.col("c_nationkey") < 5, F.lit("NA"))
            .otherwise(F.pmod("c_nationkey", F.lit(3)).cast("string"))
            .alias("wheelchair_boarding"),
            F.lit("zone").alias("zone_id"),
        ),
        "trip": orders.select(
            F.col("o_orderkey").alias("trip_id"),
            F.col("o_custkey").alias("route_id"),
            F.col("o_orderpriority").alias("service_id"),
            F.col("o_orderstatus").alias("trip_headsign"),
            F.pmod("o_orderkey", F.lit(2)).alias("direction_id"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("shape_id"),
            F.pmod("o_custkey", F.lit(3)).alias("wheelchair_accessible"),
            F.when(F.col("o_orderstatus") == "P", F.lit("NA")).otherwise(F.lit("1")).alias("bikes_allowed"),
        ),
    }


SCHEDULE_SQL = {
    "route": f"""
select lpad(cast(p_partkey as varchar), 12, '0') as route_id, p_brand as route_short_name,
  'the "' || p_name || '", line' as route_long_name, p_size as route_type, p_type as route_desc,
  case when p_size > 25 then '00FF00' end as route_color, '{LOAD_NUMBER}' as load_number from part""",
    "stop": f"""
select cast(c_custkey as varchar) as stop_id, c_name || ', "' || c_mktsegment || '"' as stop_name,
  c_acctbal as stop_lat, c_acctbal / 3 as stop_lon, c_mktsegment as stop_code,
  case when c_nationkey < 5 then null else cast(c_nationkey % 3 as int) end as wheelchair_boarding,
  '{LOAD_NUMBER}' as load_number from customer""",
    "trip": f"""
select cast(o_custkey as varchar) as route_id, cast(o_orderkey as varchar) as trip_id, o_orderpriority as service_id,
  o_orderstatus as trip_headsign, cast(o_orderkey % 2 as varchar) as direction_id,
  case when o_orderstatus <> 'P' then cast(o_totalprice as varchar) end as shape_id,
  cast(o_custkey % 3 as int) as wheelchair_accessible,
  case when o_orderstatus = 'P' then null else cast(1 as int) end as bikes_allowed,
  '{LOAD_NUMBER}' as load_number from orders""",
}


# Star inputs. A customer's number doubles as a trip id, a nation's as a route, a region's as a stop.


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = F.lpad((F.col("c_nationkey") + 5).cast("string"), 2, "0")
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("trip_id"),
        F.concat(F.lit("S"), F.pmod("c_custkey", F.lit(10))).alias("stop_id"),
        F.lit(1).alias("stop_sequence"),
        F.concat(hour, F.lit(":30:15")).alias("arrival_time"),
    )


def star_dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return {
        "dim_route": nation.select(
            F.concat(F.lit("R"), "n_nationkey").alias("route_id"), F.col("n_name").alias("route_short_name")
        ),
        "dim_stop": region.select(
            F.concat(F.lit("S"), "r_regionkey").alias("stop_id"), F.col("r_name").alias("stop_name")
        ),
        "dim_trip": customer.select(
            F.col("c_custkey").cast("string").alias("trip_id"),
            F.concat(F.lit("R"), "c_nationkey").alias("route_id"),
            F.col("c_mktsegment").alias("trip_headsign"),
        ),
    }


STOP_DELAY_SQL = f"""
with {EVENTS_SQL},
visits as (
  select start_date, route_id, trip_id, stop_id, vehicle_id,
    min(case when current_status = 'STOPPED_AT' then nullif(vehicle_timestamp, 0) end) as actual,
    avg(nullif(cast(speed as double), 0)) as avg_speed_segment
  from cvp group by all),
ranked as (
  select *, row_number() over (
    partition by start_date, route_id, trip_id, stop_id order by feed_timestamp desc, arrival_time desc) as rank
  from ctu where arrival_time <> 0),
delays as (
  select v.*, r.arrival_time as estimated, strptime(v.start_date, '%Y%m%d') as day,
    epoch_us(strptime(v.start_date, '%Y%m%d')) // 1000000 + (c.c_nationkey + 5) * 3600 + 30 * 60 + 15 as scheduled
  from visits v
  left join ranked r on r.rank = 1 and v.start_date = r.start_date and v.route_id = r.route_id
    and v.trip_id = r.trip_id and v.stop_id = r.stop_id
  left join customer c on v.trip_id = cast(c.c_custkey as varchar) and v.stop_id = 'S' || (c.c_custkey % 10)),
stop_delays as (
  select vehicle_id, route_id, trip_id, stop_id, cast(day as date) as date_id,
    make_timestamp(scheduled * 1000000) as scheduled_arrival, make_timestamp(estimated * 1000000) as estimated_arrival,
    make_timestamp(actual * 1000000) as actual_arrival,
    cast(coalesce(actual, estimated) - scheduled as int) as delay_seconds, avg_speed_segment
  from delays)
"""
