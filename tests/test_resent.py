"""Updates sent again unchanged: joined as stretches, held as few rows; and what the join's state holds."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tests.test_fact import NOON, joined, position, scattered, update
from tests.test_streaming import Lake
from tramline.operators.fact import build_fact
from tramline.operators.resent import stretches
from tramline.schemas import BRONZE_TRIP_UPDATE, VEHICLE_POSITION
from tramline.streaming.state import fullest_keys, join_operators, waiting_by_age, waiting_rows


def polls(n=60, keys=5):
    """Each key's update repeated every 15 seconds, now and then with another value, a null or twice."""
    rng, out = random.Random(4), []
    for k in range(keys):
        arrival = 100
        for i in range(n):
            if rng.random() < 0.1:
                arrival = rng.choice([None, 100, 200, 300])
            out += [update(f"t{k}", NOON + 15 * i, arrival_time=arrival)] * rng.choice([1, 1, 1, 2])
    return out


def strings(df):
    return list(map(str, values(df)))


@pytest.mark.parametrize("bound", [1, 30, 600])
@pytest.mark.parametrize("rows_per_task", [10, 10**6])
def test_batch_equals_poll_by_poll(rows, bound, rows_per_task):
    positions, updates = scattered(3, hot=True)
    more = [position(f"t{k}", NOON + 7 * i) for k in range(6) for i in range(0, 200, 9)] + [position("t1", None)]
    left, right = rows(VEHICLE_POSITION, *positions, *more), rows(BRONZE_TRIP_UPDATE, *updates, *polls())
    whole = strings(build_fact(left, right, bound))
    assert strings(build_fact(left, right, bound, rows_per_task, resent=True)) == whole


def test_few_rows_and_no_bound(rows):
    right = rows(BRONZE_TRIP_UPDATE, *[update("t", NOON + 15 * i, arrival_time=7) for i in range(80)])
    held = stretches(right, ["trip_id", "route_id", "stop_id"], 600)
    assert held.count() <= 3 and held.agg(F.sum(F.size("polls"))).first()[0] == 80
    with pytest.raises(ValueError, match="bound"):
        build_fact(right, right, None, resent=True)


def run_twice(spark, rows, path, resent):
    lake = Lake(spark, rows, path, resent=resent)
    lake.add([position(f"t{k}", NOON + 7 * i) for k in range(6) for i in range(0, 140, 9)], polls())
    lake.run()
    state = waiting_rows(lake.spark, f"{lake.path}/checkpoint").checkpoint()
    lake.flush()
    return lake, state


def test_stream_equals_batch_with_a_tenth_of_the_state(spark, rows, tmp_path):
    plain, many = run_twice(spark, rows, tmp_path / "plain", False)
    lake, few = run_twice(spark, rows, tmp_path / "resent", True)
    assert lake.fact() == plain.fact()
    left = [position(f"t{k}", NOON + 7 * i) for k in range(6) for i in range(0, 140, 9)]
    assert lake.fact() == joined(build_fact(rows(VEHICLE_POSITION, *left), rows(BRONZE_TRIP_UPDATE, *polls())))


def test_state_rows_of_a_feed_that_repeats_itself(spark, rows, tmp_path):
    counts = {}
    for resent in (False, True):
        lake = Lake(spark, rows, tmp_path / str(resent), resent=resent)
        updates = [update(f"t{k}", NOON + 15 * i, arrival_time=k) for k in range(4) for i in range(160)]
        lake.add([position("t0", NOON + 15 * 160)], updates)
        lake.run()
        state = waiting_rows(lake.spark, f"{lake.path}/checkpoint")
        counts[resent] = state.filter("side = 'right'").count()
    assert 0 < 10 * counts[True] <= counts[False]


def test_state_holds_what_may_still_be_met(spark, rows, tmp_path):
    """The watermark is five minutes before the earlier side's last time; an update within ten minutes of it may be met."""
    lake = Lake(spark, rows, tmp_path)
    positions = [position(f"t{i % 3}", NOON + 60 * i) for i in range(60)]
    updates = [update(f"t{i % 3}", NOON + 60 * i + 1) for i in range(60)]
    lake.add(positions, updates)
    lake.run()
    watermark = NOON + 60 * 59 - 300
    state = waiting_rows(lake.spark, f"{lake.path}/checkpoint")
    second = F.unix_seconds("event_time")
    held = {side: sorted(r[0] for r in state.filter(F.col("side") == side).select(second).collect()) for side in ("left", "right")}
    assert held["left"] == [NOON + 60 * i for i in range(60) if NOON + 60 * i >= watermark - 600]
    assert held["right"] == [NOON + 60 * i + 1 for i in range(60) if NOON + 60 * i + 1 >= watermark - 600]
    ages = waiting_by_age(lake.spark, f"{lake.path}/checkpoint")
    assert ages.agg(F.sum("row_count")).first()[0] == state.count()
    assert {r["key_count"] for r in ages.collect()} <= {1, 2, 3}
    top = fullest_keys(lake.spark, f"{lake.path}/checkpoint", 1).first()
    assert top["row_count"] >= len(held["left"]) // 3
    assert join_operators(lake.spark, f"{lake.path}/checkpoint") == [0]
    lake.flush()
    lake.flush()
    assert waiting_rows(lake.spark, f"{lake.path}/checkpoint").filter("NOT startswith(trip_id, '~')").isEmpty()
