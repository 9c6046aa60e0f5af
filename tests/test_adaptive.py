"""A stream whose routing follows keys that turn hot: every pair once, across any number of changes."""

import random

import pytest
from pyspark.sql import functions as F

from tests.test_fact import NOON, instant, joined, position, update
from tests.test_streaming import FAR
from tramline.operators.fact import build_fact
from tramline.schemas import BRONZE_TRIP_UPDATE, VEHICLE_POSITION
from tramline.session import stream_session
from tramline.sources.tables import UNTIL_DRAINED, read_table, write_table
from tramline.streaming.adaptive import Routing, processed_files, silver_fact_adaptive
from tramline.streaming.state import join_operators


class Lake:
    def __init__(self, spark, rows, path, rows_per_task):
        self.spark, self.rows, self.path, self.rows_per_task = stream_session(spark, 4), rows, str(path), rows_per_task
        self.checkpoint = f"{self.path}/checkpoint"
        self.positions, self.updates = [], []

    def add(self, positions=(), updates=()):
        self.positions += positions
        self.updates += updates
        write_table(self.rows(VEHICLE_POSITION, *positions), f"{self.path}/vehicle_positions", mode="append")
        write_table(self.rows(BRONZE_TRIP_UPDATE, *updates), f"{self.path}/trip_updates", mode="append")

    def run(self):
        tables = (f"{self.path}/vehicle_positions", f"{self.path}/trip_updates")
        query = silver_fact_adaptive(
            self.spark, *tables, f"{self.path}/fact", self.checkpoint, UNTIL_DRAINED, rows_per_task=self.rows_per_task
        )
        query.awaitTermination()

    def routes(self):
        return Routing(self.spark, self.checkpoint).routes().orderBy("generation", "cell").collect()

    def fact(self):
        return joined(read_table(self.spark, f"{self.path}/fact").filter(~F.col("trip_id").startswith("~")))

    def batch(self):
        fact = build_fact(self.rows(VEHICLE_POSITION, *self.positions), self.rows(BRONZE_TRIP_UPDATE, *self.updates))
        return joined(fact.filter(~F.col("trip_id").startswith("~")))


def burst(key, start, n, seed=0):
    """Rows of a key over a quarter of an hour, none too late after the burst before."""
    draw = random.Random(seed)
    at = [start + draw.randrange(900) for _ in range(n)]
    return [position(key, t) for t in at], [update(key, t + draw.choice([-250, 0, 599, 600, 601])) for t in at[::2]]


@pytest.fixture
def lake(spark, rows, tmp_path):
    return Lake(spark, rows, tmp_path / "a b+c", 8)


def test_a_key_that_turns_hot_is_split_and_every_pair_met_once(lake):
    """Bursts follow each other closely, so pairs reach across each change."""
    lake.add(*burst("quiet", NOON, 6))
    lake.run()
    assert lake.routes() == []
    for i, n in enumerate((30, 60, 240), 1):
        lake.add(*burst("hot", NOON + 900 * i, n, seed=i))
        lake.run()
    routes = lake.routes()
    assert len({r["cell"] for r in routes}) == 1 and len(routes) >= 2
    parts = [r["left_parts"] for r in routes]
    assert parts == sorted(parts) and parts[-1] > 4
    since = [r["since"] for r in routes]
    assert since == sorted(since)
    lake.add(*burst("hot", NOON + 3600, 200, seed=9))
    lake.add([position("hot", NOON + 5400), position("hot", NOON + 7200)])
    lake.run()
    lake.add([position("~left", FAR)], [update("~right", FAR)])
    lake.run()
    assert lake.fact() == lake.batch()


def test_rows_not_yet_processed_do_not_put_off_a_change(spark, rows, tmp_path):
    lake = Lake(spark, rows, tmp_path / "plain", 8)  # the state reader takes no blanks in a path
    lake.add(*burst("hot", NOON, 5))
    lake.run()
    lake.add(*burst("hot", NOON + 3600, 300))
    lake.run()
    (route,) = lake.routes()
    last = max(p["vehicle_timestamp"] for p in lake.positions[:5])
    assert last + 600 < route["since"] / 1_000_000 <= NOON + 3600 - 600 + 1
    # The new rows are spread over the parts of both halves of the state.
    state = lake.spark.read.format("statestore").option("joinSide", "left")
    number = join_operators(lake.spark, lake.checkpoint)[0]
    held = state.option("operatorId", number).load(lake.checkpoint)
    assert held.select("value.left_part").distinct().count() > 4


def test_hot_from_the_start(lake):
    lake.add(*burst("hot", NOON, 300))
    lake.run()
    (route,) = lake.routes()
    assert route["since"] < 0 and route["left_parts"] > 4
    lake.add([position("~left", FAR)], [update("~right", FAR)])
    lake.run()
    assert lake.fact() == lake.batch()
    assert len(lake.routes()) == 1  # nothing grew


def test_start_on_little_and_processed_files(spark, lake):
    lake.add([position("k", None)], [update("k", None)])
    assert processed_files(lake.spark, lake.checkpoint).count() == 0
    lake.run()
    assert lake.routes() == []
    names = {r["item"] for r in processed_files(lake.spark, lake.checkpoint).collect()}
    stored = read_table(spark, f"{lake.path}/vehicle_positions", columns=VEHICLE_POSITION).select(F.input_file_name())
    assert all("a b+c" in name for name in names) and names
    assert Routing(lake.spark, lake.checkpoint).follow(f"{lake.path}/vehicle_positions", f"{lake.path}/trip_updates") == 0
    assert stored.count() == 1 and instant(None) is None
