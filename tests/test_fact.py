"""The fact join against brute force, with and without splitting."""

import random
from collections import Counter
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, values
from tramline import session
from tramline.operators import skew
from tramline.operators.fact import build_fact
from tramline.plans.fact import fact_of_days
from tramline.schemas import BRONZE_TRIP_UPDATE, FACT, VEHICLE_POSITION

NOON = 1_700_000_000 // 3600 * 3600


def instant(second):
    return None if second is None else datetime.fromtimestamp(second, timezone.utc)


def position(key="k", at=NOON, **more):
    return {"trip_id": key, "route_id": "r", "stop_id": "s", "vehicle_timestamp": at, "vehicle_id": "v"} | more


def update(key="k", at=NOON, **more):
    return {"trip_id": key, "route_id": "r", "stop_id": "s", "ingested_at": instant(at), "arrival_time": 1} | more


def joined(df):
    """(trip, position second, update second) of each fact row, counted."""
    seconds = df.select("trip_id", F.unix_seconds("vehicle_timestamp"), F.unix_micros("ingested_at") / 1_000_000)
    return Counter(tuple(row) for row in seconds.collect())


def brute_force(positions, updates, bound):
    out = Counter()
    keys = ("trip_id", "route_id", "stop_id")
    usable = [[row for row in side if all((row[k] or "").strip(" ") for k in keys)] for side in (positions, updates)]
    for p in usable[0]:
        at = p["vehicle_timestamp"]
        hits = []
        for u in usable[1]:
            seen = u["ingested_at"] and u["ingested_at"].timestamp()
            if any(p[k] != u[k] for k in keys):
                continue
            if bound is None or (None not in (at, seen) and abs(at - seen) <= bound):
                hits.append(seen)
        out.update((p["trip_id"], at, seen) for seen in hits or [None])
    return out


def test_columns_and_types(rows):
    got = build_fact(rows(VEHICLE_POSITION, position()), rows(BRONZE_TRIP_UPDATE, update()))
    assert dict(got.dtypes) == FACT and got.columns == list(FACT)


def test_both_ends_of_the_bound(rows):
    positions = [
        position("two", NOON),
        position("early", NOON + 600),
        position("late", NOON),
        position("too early", NOON + 600),
        position("too late", NOON),
        position("alone"),
        position("no time", None),
        position("other trip"),
        position(""),
    ]
    updates = [
        update("two", NOON),
        update("two", NOON + 120),
        update("early", NOON),
        update("late", NOON + 600),
        update("too early", NOON - 1),
        update("too late", NOON + 601),
        update("no time"),
        update("nobody"),
        update(""),
        update("alone", None),
    ]
    got = joined(build_fact(rows(VEHICLE_POSITION, *positions), rows(BRONZE_TRIP_UPDATE, *updates)))
    assert got == brute_force(positions, updates, 600)
    assert got[("early", NOON + 600, NOON)] == 1 and got[("no time", None, None)] == 1
    assert got[("too early", NOON + 600, None)] == 1 and got[("too late", NOON, None)] == 1


def scattered(seed, hot):
    """Random rows around slot and step edges; hot ones pile copies onto one key and instant."""
    draw = random.Random(seed)
    edges = [NOON + step * 600 + shift for step in range(-8, 9) for shift in (-1, 0, 1)]
    spread = [NOON + draw.randrange(-9000, 9000) for _ in range(30)]

    def key():
        return draw.choice(["a", "b", "c", "d", "", None])

    positions = [position(key(), draw.choice([*edges, *spread, None])) for _ in range(120)]
    updates = [update(key(), draw.choice([*edges, *spread, None])) for _ in range(120)]
    if hot:
        positions += [position("a", NOON)] * 90 + [position("hot left", NOON + 30 * i) for i in range(60)]
        updates += [update("a", NOON - 600)] * 40 + [update("hot right", NOON + 30 * i) for i in range(60)]
        positions += [position("hot right", NOON), position("hot right", NOON + 5000)]
        updates += [update("hot left", NOON + 600)]
    return positions, updates


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("bound", [600, 1, 4000, None])
@pytest.mark.parametrize("rows_per_task", [1, 10, skew.ROWS_PER_TASK])
def test_random_rows_match_brute_force(rows, monkeypatch, seed, bound, rows_per_task):
    monkeypatch.setattr(skew, "COPIES_PER_CHUNK", 7)
    positions, updates = scattered(seed, hot=True)
    got = build_fact(rows(VEHICLE_POSITION, *positions), rows(BRONZE_TRIP_UPDATE, *updates), bound, rows_per_task)
    assert joined(got) == brute_force(positions, updates, bound)


def test_microsecond_past_the_bound(spark, rows):
    table = rows(BRONZE_TRIP_UPDATE, update()).withColumn("ingested_at", F.timestamp_micros(F.lit((NOON + 600) * 1_000_000 + 1)))
    for rows_per_task in (0, skew.ROWS_PER_TASK):
        got = build_fact(rows(VEHICLE_POSITION, position()), table, 600, rows_per_task)
        assert joined(got) == Counter({("k", NOON, None): 1})


@pytest.mark.parametrize("bound", [600, None])
def test_splitting_keeps_every_float_as_it_is(rows, bound):
    odd = [-0.0, 0.0, float("nan"), float("inf"), None, 1.5]
    positions = [position(latitude=x, speed=x, vehicle_id=f"v{i}") for i, x in enumerate(odd)] * 3

    def text(rows_per_task):
        fact = build_fact(rows(VEHICLE_POSITION, *positions), rows(BRONZE_TRIP_UPDATE, update(), update()), bound, rows_per_task)
        return Counter(tuple(row) for row in fact.selectExpr("vehicle_id", "string(latitude)", "string(speed)").collect())

    assert text(1) == text(skew.ROWS_PER_TASK)
    assert text(1)[("v0", "-0.0", "-0.0")] == 6 and text(1)[("v1", "0.0", "0.0")] == 6


def test_cells_are_judged_by_pairs_too(spark):
    counts = spark.createDataFrame([(1, 1_900_000, 1_900_000), (2, 10, 10)], "cell int, left_rows bigint, right_rows bigint")
    (hot,) = skew.plan_split(counts).hot.collect()
    assert hot.cell == 1
    assert 1_900_000 / hot.left_parts * (1_900_000 / hot.right_parts) <= skew.PAIRS_PER_TASK
    assert hot.left_parts * hot.right_parts < 4 * 1_900_000**2 / skew.PAIRS_PER_TASK
    one_sided = spark.createDataFrame([(1, 1_900_000, 3)], "cell int, left_rows bigint, right_rows bigint")
    assert skew.plan_split(one_sided).hot is None
    few = spark.createDataFrame([(1, 1_900_000, 4_000)], "cell int, left_rows bigint, right_rows bigint")
    (hot,) = skew.plan_split(few, pairs_per_task=1000).hot.collect()
    assert hot.right_parts <= 4_000


def test_positions_without_a_time_are_spread(spark, rows):
    positions = rows(VEHICLE_POSITION, *[position(at=None, vehicle_id=f"v{i}") for i in range(200)])
    positions = positions.withColumn("vehicle_timestamp", F.when(F.col("vehicle_id") > "v5", F.lit(1 << 60)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fact = build_fact(positions, rows(BRONZE_TRIP_UPDATE, update()))
        assert fact.count() == 200 and fact.filter("vehicle_timestamp is not null").isEmpty()
        assert fact.select(F.spark_partition_id()).distinct().count() == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_key_is_split_evenly(spark, monkeypatch):
    """A third of all rows are copies of one position; no part holds much more than its share."""
    monkeypatch.setattr(skew, "COPIES_PER_CHUNK", 50)
    hot = spark.range(10_000).select(F.lit("hot").alias("key"))
    rest = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    left, right = hot.union(rest), rest
    cells = skew.plan_split(skew.stored(skew.cell_counts(left, right, ["key"])), rows_per_task=500).hot
    (cell,) = cells.collect()
    assert cell.left_parts == 20 and cell.right_parts == 1
    parts = skew.collapse_copies(skew.inside(left, ["key"], cells), "left_parts", "part", "weight")
    loads = [row.load for row in parts.groupBy("part").agg(F.sum("weight").alias("load")).collect()]
    assert sum(loads) >= 10_000 and len(loads) == 20 and max(loads) <= 1_000
    # The part is drawn from values, so a recomputed task gives every row the same one.
    again = skew.collapse_copies(skew.inside(left.repartition(7), ["key"], cells), "left_parts", "part", "weight")
    assert values(again) == values(parts)


def test_cell_table_is_bounded_and_usually_empty(spark):
    table = spark.range(200_000).select(F.col("id").alias("key"))
    counts = skew.stored(skew.cell_counts(table, table, ["key"]))
    assert counts.count() <= skew.CELLS
    assert skew.plan_split(counts) == skew.Split(400_000, None)
    assert skew.CELLS * 12 < 10 * 1024 * 1024


def test_usual_plan_is_one_join_with_pushed_filters(spark, rows, tmp_path):
    rows(VEHICLE_POSITION, position()).write.parquet(str(tmp_path / "p"))
    rows(BRONZE_TRIP_UPDATE, update()).write.parquet(str(tmp_path / "u"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(build_fact(spark.read.parquet(str(tmp_path / "p")), spark.read.parquet(str(tmp_path / "u"))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange") == 2 and plan.count("FileScan") == 2
    assert "IsNotNull(trip_id)" in plan and "IsNotNull(ingested_at)" in plan
    assert "license_plate" not in plan and "feed_timestamp" not in plan


def test_days_are_the_whole_fact_restricted(spark, rows, tmp_path):
    day = NOON // 86_400 * 86_400
    edges = [day + shift for shift in (-86_400, -1, 0, 300, 86_399, 86_400, 90_000)]
    rows(VEHICLE_POSITION, *[position(at=at) for at in [*edges, None]]).write.parquet(str(tmp_path / "p"))
    near = [update(at=at + shift) for at in edges for shift in (-600, 0, 600)]
    rows(BRONZE_TRIP_UPDATE, *near).write.parquet(str(tmp_path / "u"))
    tables = spark.read.parquet(str(tmp_path / "p")), spark.read.parquet(str(tmp_path / "u"))
    when = datetime.fromtimestamp(day, timezone.utc).date()
    part = fact_of_days(*tables, 600, when, when)
    whole = joined(build_fact(*tables, 600))
    assert joined(part) == Counter({row: n for row, n in whole.items() if row[1] and day <= row[1] < day + 86_400})
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    try:
        plan = plan_of(part)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(vehicle_timestamp" in plan and "LessThanOrEqual(ingested_at" in plan


def test_bound_below_a_second_is_refused(rows):
    with pytest.raises(ValueError):
        build_fact(rows(VEHICLE_POSITION), rows(BRONZE_TRIP_UPDATE), 0)


def test_shuffles_grow_with_the_rows(spark, rows, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_PARTITION", 10)
    positions, updates = scattered(1, hot=True)
    tables = rows(VEHICLE_POSITION, *positions), rows(BRONZE_TRIP_UPDATE, *updates)
    try:
        got = build_fact(*tables)
        raised = int(spark.conf.get(session.INITIAL_PARTITIONS))
        assert 30 <= raised <= 60
        session.raise_partitions(spark, 1)
        assert int(spark.conf.get(session.INITIAL_PARTITIONS)) == raised
        assert joined(got) == brute_force(positions, updates, 600)
    finally:
        spark.conf.unset(session.INITIAL_PARTITIONS)
