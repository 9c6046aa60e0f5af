"""Time every headline query over whole tables and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from checks.registry import QUERIES
from tramline.session import get_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "clean_vehicle_positions",
    "bronze_json_parse",
    "json_round_trip",
    "feed_flatten_vehicle",
    "feed_flatten_trip_updates",
    "poll_row_counts",
    "static_dim_trip",
    "vehicle_dim",
    "vehicle_dim_latest",
    "fact_interval_10m",
    "fact_interval_6h",
    "fact_unbounded",
    "fact_interval_6h_split",
    "stop_delay",
    "star_lookup",
    "pk_violations",
    "fk_orphans",
    "stream_bronze_trip_updates",
    "stream_fact_10m",
    "stream_fact_6h",
]


def main() -> None:
    conf = {
        "spark.master": f"local[{CPUS}]",
        "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": CPUS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    spark = get_session("bench", conf)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["poll_row_counts"](spark, SF_DIR).write.format("noop").mode("overwrite").save()  # start-up cost
    seconds = {}
    for name in HEADLINE:
        start = time.monotonic()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - start, 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": SF_DIR}))


if __name__ == "__main__":
    main()
