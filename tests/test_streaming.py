"""Streams over staged topics: bounds, flush, late rows, restarts, stream equals batch."""

from datetime import datetime, timezone

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.conftest import plan_of, values
from tests.test_fact import NOON, joined, position, scattered, update
from tramline.functions import JOIN_KEYS
from tramline.operators import skew
from tramline.operators.fact import build_fact, clean_positions
from tramline.operators.messages import encode
from tramline.schemas import BRONZE_TRIP_UPDATE, TRIP_UPDATE, VEHICLE_POSITION
from tramline.session import stream_session
from tramline.sources.tables import UNTIL_DRAINED, read_table, stream_table, with_source_row, write_table
from tramline.sources.topics import read_topic, write_topic
from tramline.streaming import jobs
from tramline.streaming.state import waiting_rows

FAR = NOON + 10_000_000
SIDES = ["left_rows", "right_rows"]


class Lake:
    """Bronze tables that grow by appended files, and the fact stream over them."""

    def __init__(self, spark, rows, path, rows_per_task=None, resent=False):
        self.spark, self.rows, self.path = stream_session(spark, 2), rows, str(path)
        self.rows_per_task, self.resent = rows_per_task, resent

    def add(self, positions=(), updates=()):
        for name, columns, new in (
            ("vehicle_positions", VEHICLE_POSITION, positions),
            ("trip_updates", BRONZE_TRIP_UPDATE, updates),
        ):
            write_table(self.rows(columns, *new), f"{self.path}/{name}", mode="append")

    def run(self):
        query = jobs.silver_fact(
            self.spark,
            f"{self.path}/vehicle_positions",
            f"{self.path}/trip_updates",
            f"{self.path}/fact",
            f"{self.path}/checkpoint",
            trigger=UNTIL_DRAINED,
            rows_per_task=self.rows_per_task,
            resent=self.resent,
        )
        query.awaitTermination()
        self.last = query
        return query

    def flush(self):
        self.add([position("~left", FAR)], [update("~right", FAR)])
        return self.run()

    def fact(self):
        rows = read_table(self.spark, f"{self.path}/fact")
        return joined(rows.filter(~F.col("trip_id").startswith("~")))


@pytest.fixture
def lake(spark, rows, tmp_path):
    return Lake(spark, rows, tmp_path)


def dropped_late(query):
    return sum(
        operator["numRowsDroppedByWatermark"] for step in query.recentProgress for operator in step["stateOperators"]
    )


@pytest.mark.parametrize("rows_per_task", [None, 10])
def test_stream_equals_batch_for_rows_with_a_time(spark, rows, tmp_path, rows_per_task):
    lake = Lake(spark, rows, tmp_path, rows_per_task)
    positions, updates = scattered(5, hot=True)
    lake.add(positions, updates)
    lake.run()
    lake.flush()
    # Only the flush rows are left in the state of each join.
    assert sum(o["numRowsTotal"] for o in lake.last.lastProgress["stateOperators"]) <= 6
    timed = [p for p in positions if p["vehicle_timestamp"] is not None]
    assert lake.fact() == joined(build_fact(rows(VEHICLE_POSITION, *timed), rows(BRONZE_TRIP_UPDATE, *updates)))


@pytest.mark.parametrize("rows_per_task", [None, 10])
def test_rows_in_time_order_over_several_runs(spark, rows, tmp_path, rows_per_task):
    positions, updates = scattered(6, hot=True)
    positions = [p for p in positions if p["vehicle_timestamp"] is not None]
    lake = Lake(spark, rows, tmp_path, rows_per_task)
    edges = [0, NOON - 1500, NOON, NOON + 1500, FAR]
    for first, last in zip(edges, edges[1:]):
        lake.add(
            [p for p in positions if first <= p["vehicle_timestamp"] < last],
            [u for u in updates if u["ingested_at"] and first <= u["ingested_at"].timestamp() < last],
        )
        if first == 0 and rows_per_task:
            # Measured once, so the split comes from the first part of the rows alone.
            lake.add([position("hot left", NOON - 2000)] * 30, [update("hot right", NOON - 2000)] * 30)
            positions += [position("hot left", NOON - 2000)] * 30
            updates += [update("hot right", NOON - 2000)] * 30
        lake.run()
    lake.flush()
    if rows_per_task:
        split = read_table(spark, f"{tmp_path}/checkpoint-split").agg(F.max("left_parts"), F.max("right_parts"))
        assert all(parts > 1 for parts in split.first())
    assert lake.fact() == joined(build_fact(rows(VEHICLE_POSITION, *positions), rows(BRONZE_TRIP_UPDATE, *updates)))


def test_unmatched_rows_wait_for_both_watermarks(lake):
    lake.add([position("hit"), position("alone")], [update("hit", NOON + 600)])
    lake.run()
    assert lake.fact() == {("hit", NOON, NOON + 600): 1}
    lake.run()  # nothing new, nothing flushed
    assert ("alone", NOON, None) not in lake.fact()
    lake.flush()
    assert lake.fact() == {("hit", NOON, NOON + 600): 1, ("alone", NOON, None): 1}


def test_match_across_runs_of_one_checkpoint(lake):
    lake.add([position("k")], [])
    lake.run()
    lake.add([], [update("k", NOON - 600), update("k", NOON - 601)])
    lake.run()
    lake.run()
    assert lake.fact() == {("k", NOON, NOON - 600): 1}


def test_late_position_is_dropped_where_batch_keeps_it(lake):
    lake.add([position("now", NOON)], [update("now", NOON)])
    lake.run()
    lake.add([position("late", NOON - 3600)], [update("late", NOON - 3600)])
    late = lake.run()
    lake.flush()
    assert lake.fact() == {("now", NOON, NOON): 1}
    assert dropped_late(late) == 2


def test_position_without_time_never_enters_the_state(lake):
    lake.add([position("no time", None)], [update("no time")])
    query = lake.run()
    assert sum(o["numRowsTotal"] for o in query.lastProgress["stateOperators"]) <= 1  # the update only
    lake.flush()
    assert lake.fact() == {}


def test_split_is_fixed_for_a_checkpoint(spark, rows, tmp_path):
    lake = Lake(spark, rows, tmp_path, rows_per_task=5)
    lake.add([position("k", NOON + i) for i in range(20)], [update("k")])
    lake.run()
    stored = values(read_table(spark, f"{tmp_path}/checkpoint-split"))
    assert [row[1:] for row in stored] == [(4, 1)]
    lake.add([position("k", NOON + i) for i in range(100)], [update("k", NOON + 1)])
    lake.run()
    assert values(read_table(spark, f"{tmp_path}/checkpoint-split")) == stored
    assert sum(lake.fact().values()) == 20 * 2 + 100 * 2


def test_one_bad_number_does_not_stop_the_fact(lake):
    lake.add([position("bad", 1_704_067_200_000_000), position("good")], [update("good", NOON)])
    lake.run()
    lake.add([position("bad", 1 << 62), position("later", NOON + 60)], [update("later", NOON + 60)])
    lake.run()
    lake.flush()
    assert lake.fact() == {("good", NOON, NOON): 1, ("later", NOON + 60, NOON + 60): 1}


def test_half_written_split_is_written_anew(spark, rows, tmp_path):
    lake = Lake(spark, rows, tmp_path, rows_per_task=5)
    lake.add([position("k", NOON + i) for i in range(20)], [update("k")])
    (tmp_path / "checkpoint-split" / "_temporary").mkdir(parents=True)
    lake.run()
    assert [row[1:] for row in values(read_table(spark, f"{tmp_path}/checkpoint-split"))] == [(4, 1)]
    assert sum(lake.fact().values()) == 20


def test_known_hot_keys_split_a_start_on_empty_tables(spark, rows, tmp_path):
    history = rows(VEHICLE_POSITION, *[position("k", NOON + i) for i in range(20)])
    known = jobs.plan_stream_split(history, rows(BRONZE_TRIP_UPDATE, *[update("k")] * 12), rows_per_task=5)
    lake = Lake(spark, rows, tmp_path, rows_per_task=5)
    lake.add()

    def run():
        paths = [f"{tmp_path}/{name}" for name in ("vehicle_positions", "trip_updates", "fact", "checkpoint")]
        jobs.silver_fact(lake.spark, *paths, trigger=UNTIL_DRAINED, rows_per_task=5, split=known).awaitTermination()

    run()
    positions, updates = [position("k", NOON + i) for i in range(30)], [update("k", NOON + i) for i in range(9)]
    lake.add(positions, updates)
    run()
    lake.add([position("~left", FAR)], [update("~right", FAR)])
    run()
    assert [row[1:] for row in values(read_table(spark, f"{tmp_path}/checkpoint-split"))] == [(4, 3)]
    assert lake.fact() == joined(build_fact(rows(VEHICLE_POSITION, *positions), rows(BRONZE_TRIP_UPDATE, *updates)))


def test_long_history_alone_is_not_hot(spark, rows):
    """The state never holds it, so it needs no split."""
    days = rows(VEHICLE_POSITION, *[position("k", NOON + 86_400 * i) for i in range(50)])
    assert jobs.plan_stream_split(days, rows(BRONZE_TRIP_UPDATE, update("k")), rows_per_task=5) is None


@pytest.mark.parametrize("options", [{}, {"resent": True}, {"rows_per_task": 5}])
def test_history_of_a_key_is_joined_slot_by_slot(spark, rows, tmp_path, options):
    """A first batch holds all history; without the slot each row would be held against all of its key."""
    edge = NOON + 1800
    positions = [position("k", edge + 3600 * day + i) for day in range(0, 120, 24) for i in (-601, -600, -1, 0, 1, 599, 600)]
    updates = [update("k", edge + 3600 * day + i) for day in range(0, 120, 24) for i in (-1201, -600, -1, 0, 599, 600, 1200)]
    lake = Lake(spark, rows, tmp_path, **options)
    lake.add(positions, updates)
    lake.run()
    joins = [line for line in plan_of(lake.last).splitlines() if "SymmetricHashJoin" in line]
    assert joins and all("slot#" in line.split("]")[0] for line in joins)
    lake.flush()
    assert lake.fact() == joined(build_fact(rows(VEHICLE_POSITION, *positions), rows(BRONZE_TRIP_UPDATE, *updates)))


def test_update_in_reach_of_two_slots_waits_once(lake):
    edge = NOON + 1800
    lake.add([position("k", edge)], [update("k", edge + i) for i in (-1, 0, 600)])
    lake.run()
    assert lake.last.lastProgress["stateOperators"][0]["numRowsTotal"] > 4
    held = waiting_rows(lake.spark, f"{lake.path}/checkpoint").groupBy("side").count()
    assert values(held) == [("left", 1), ("right", 3)]


def test_parts_of_a_split_do_not_grow_with_the_table(spark):
    """Each part is a copy of all rows of the other side, so many equal cells need but two."""
    for size in (1, 50):
        even = spark.range(1000).select(F.col("id").cast("int").alias("cell"), *(F.lit(20 * size).alias(n) for n in SIDES))
        hot = skew.plan_split(even, rows_per_task=8, tasks=4).hot
        assert hot.select("left_parts", "right_parts").distinct().collect() == [(2, 2)] and hot.count() == 1000
    one = spark.createDataFrame([(1000, 10_000, 5_000)], ["cell", *SIDES])
    hot = skew.plan_split(even.union(one), rows_per_task=8, tasks=400).hot
    assert hot.filter("cell = 1000").select("left_parts", "right_parts").first() == (32, 16)


def test_lonely_positions_are_found_by_steps_and_late_updates_do_not_hide_them(spark, rows, tmp_path):
    """Both sides split: many updates of a step are one row of the second join, and one too late counts nowhere."""
    lake = Lake(spark, rows, tmp_path, rows_per_task=5)
    positions = [position("k", NOON + 20 * i) for i in range(20)]
    updates = [update("k", NOON + 5 * i) for i in range(100)]
    lake.add([*positions, position("k", NOON + 3600)], [*updates, update("k", NOON + 3600)])
    first = lake.run()
    joins = [o for o in first.recentProgress[0]["stateOperators"] if o["operatorName"] == "symmetricHashJoin"]
    assert len(joins) == 2 and joins[1]["numRowsUpdated"] <= 40  # 21 positions, and the steps in each part
    watermark = NOON + 3600 - 300  # in the middle of a step
    lake.add([position("k", watermark + 10 - 600)], [update("k", watermark - 100)])
    lake.add([position("k", watermark + 500)], [])
    late = lake.run()
    assert dropped_late(late) > 0
    lake.flush()
    want = joined(build_fact(rows(VEHICLE_POSITION, *positions), rows(BRONZE_TRIP_UPDATE, *updates)))
    assert lake.fact() == want | {("k", NOON + 3600, NOON + 3600): 1, ("k", watermark + 500, NOON + 3600): 1}
    alone = Lake(spark, rows, tmp_path / "alone", rows_per_task=5)
    alone.add(positions, updates)
    alone.add([position("other", NOON + 3600)], [update("other", NOON + 3600)])
    alone.run()
    alone.add([position("k", watermark + 100)], [update("k", watermark - 100)])
    alone.run()
    alone.flush()
    assert alone.fact() == want | {("other", NOON + 3600, NOON + 3600): 1, ("k", watermark + 100, None): 1}


def test_stored_copies_are_spread_over_the_parts(spark, rows, tmp_path):
    write_table(rows(VEHICLE_POSITION, *[position()] * 400).coalesce(1), f"{tmp_path}/p")
    copies = clean_positions(with_source_row(read_table(spark, f"{tmp_path}/p")))
    hot = copies.select(skew.cell(JOIN_KEYS).alias("cell"), F.lit(4).alias("left_parts"), F.lit(1).alias("right_parts"))
    marked = jobs._with_part(copies, hot.distinct(), "left_parts", "left_part")
    loads = values(marked.groupBy("left_part").count())
    assert [part for part, _ in loads] == [0, 1, 2, 3] and all(60 <= load <= 140 for _, load in loads)


def test_left_outer_join_needs_the_bound(spark, rows, tmp_path):
    write_table(rows(VEHICLE_POSITION), f"{tmp_path}/p")
    write_table(rows(BRONZE_TRIP_UPDATE), f"{tmp_path}/u")
    fact = jobs.stream_fact(
        stream_table(spark, f"{tmp_path}/p", VEHICLE_POSITION),
        stream_table(spark, f"{tmp_path}/u", BRONZE_TRIP_UPDATE),
        bound=None,
    )
    with pytest.raises(AnalysisException):
        fact.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/c").start()


@pytest.mark.parametrize("fmt", ["parquet", "text"])
def test_bronze_from_topic_once_per_message(spark, rows, tmp_path, fmt):
    def send(*updates):
        write_topic(encode(rows(TRIP_UPDATE, *updates)), f"{tmp_path}/topic", fmt)

    def run():
        jobs.bronze_updates(
            spark, f"{tmp_path}/topic", f"{tmp_path}/bronze", f"{tmp_path}/checkpoint", fmt, trigger=UNTIL_DRAINED
        ).awaitTermination()

    started = datetime.now(timezone.utc).timestamp()
    send({"entity_id": "a", "arrival_time": 5}, {"entity_id": "b"})
    run()
    send({"entity_id": "c"})
    run()
    run()
    bronze = read_table(spark, f"{tmp_path}/bronze")
    assert dict(bronze.dtypes) == BRONZE_TRIP_UPDATE
    assert sorted(row.entity_id for row in bronze.collect()) == ["a", "b", "c"]
    stamps = bronze.groupBy(F.unix_millis("ingested_at").alias("at")).count().orderBy("at").collect()
    assert [row["count"] for row in stamps] == [2, 1]  # one processing time per micro-batch
    assert stamps[0]["at"] >= started * 1000 - 1


def test_bad_messages_do_not_stop_the_stream(spark, tmp_path):
    payloads = [(b"not json",), (None,), (b'{"entity_id":"a"}',)]
    write_topic(spark.createDataFrame(payloads, "value binary"), f"{tmp_path}/t", "parquet")
    jobs.bronze_positions(
        spark, f"{tmp_path}/t", f"{tmp_path}/b", f"{tmp_path}/c", "parquet", trigger=UNTIL_DRAINED
    ).awaitTermination()
    bronze = read_table(spark, f"{tmp_path}/b")
    assert dict(bronze.dtypes) == VEHICLE_POSITION
    assert values(bronze.select("entity_id")) == [(None,), (None,), ("a",)]


def test_queue_options_reach_the_reader(monkeypatch):
    """No connector is installed here, so a stand-in reader records what it is given."""

    class Reader:
        def __init__(self):
            self.seen = {}

        def format(self, name):
            self.seen["format"] = name
            return self

        def option(self, key, value):
            self.seen[key] = value
            return self

        def options(self, **more):
            self.seen |= more
            return self

        def load(self):
            return self

        def select(self, *columns):
            return self.seen

    class Session:
        readStream = Reader()

    seen = read_topic(Session(), "topic", "kafka", "host:9092", jobs.UPDATES_OPTIONS)
    assert seen == {
        "format": "kafka",
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "topic",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    assert "failOnDataLoss" not in jobs.POSITIONS_OPTIONS


def test_stream_settings_stay_in_their_session(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    session = stream_session(spark, 3)
    assert session.conf.get("spark.sql.shuffle.partitions") == "3"
    assert "RocksDB" in session.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
