"""The command line, end to end over plain files."""

import json

import pytest

from tests.test_dims import ROUTES, STOPS, TRIPS
from tests.test_feed import SNAPSHOTS
from tramline import jobs
from tramline.sources.tables import read_table


@pytest.fixture
def lake(spark, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    for name, text in (("stops", STOPS), ("routes", ROUTES), ("trips", TRIPS)):
        (files / f"{name}.txt").write_text(text, encoding="utf-8")
    snapshots = tmp_path / "snapshots"
    snapshots.mkdir()
    (snapshots / "1.json").write_text("\n".join(json.dumps(snapshot) for snapshot in SNAPSHOTS))
    return str(tmp_path)


def test_all_jobs(spark, lake):
    def run(*args):
        jobs.main([arg.replace("@", f"{lake}/") for arg in args])

    for part, job, table in (
        ("vehicle_positions", "bronze-positions", "vehicle_positions"),
        ("trip_updates", "bronze-updates", "trip_updates"),
    ):
        topic = ["--topic-format", "parquet", "--topic", f"@topic/{part}", "--once"]
        run("publish-feed", "--snapshots", "@snapshots", "--part", part, "--checkpoint", f"@c/publish-{part}", *topic)
        run(job, "--path", f"@bronze/{table}", "--checkpoint", f"@c/{job}", *topic)
    run("load-static", "--files", "@files", "--bronze", "@bronze", "--audit", "@audit")
    run("silver-dims", "--bronze", "@bronze", "--silver", "@silver")
    stream = ["--checkpoint", "@c/fact", "--once", "--state-partitions", "2"]
    run("silver-fact", "--bronze", "@bronze", "--silver", "@silver", *stream)
    run("backfill-fact", "--bronze", "@bronze", "--silver", "@batch", "--unbounded")
    run("warehouse", "--bronze", "@bronze", "--target", "@star")

    def count(path):
        return read_table(spark, f"{lake}/{path}").count()

    assert (count("bronze/vehicle_positions"), count("bronze/trip_updates")) == (4, 4)
    assert (count("bronze/dim_stop"), count("silver/stop"), count("silver/vehicle")) == (2, 2, 1)
    assert count("audit") == 3
    assert count("batch/fact") == 1
    assert (count("star/fact_stop_delay"), count("star/audit_pipeline_runs")) == (1, 6)


def test_a_missing_schedule_folder_fails(spark, lake):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.main(["load-static", "--files", f"{lake}/nowhere", "--bronze", f"{lake}/bronze"])


def test_counts_outlast_what_a_query_remembers(capsys):
    steps = [{"batchId": i, "numInputRows": i % 7} for i in range(1000)]
    counts = jobs.BatchCounts()
    for end in range(0, 1001, 60):
        counts.add(steps[max(0, end - 100) : end])
    counts.add(steps[-100:] + steps[-1:])
    assert (counts.batches, counts.rows, counts.missed) == (1000, sum(s["numInputRows"] for s in steps), 0)
    counts.add([{"batchId": 1004, "numInputRows": 1}])
    assert counts.missed == 4
    assert "batch 999" in capsys.readouterr().out


def test_a_drained_query_reports_all_its_batches(spark, tmp_path):
    for i in range(120):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{i}.txt").write_text(f"{i}")
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(f"{tmp_path}/in").writeStream
    query = stream.format("noop").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    counts = jobs._finish(query, every=0.2)
    assert (counts.batches, counts.rows, counts.missed) == (120, 120, 0)


def test_bronze_jobs_run_every_two_minutes(monkeypatch, spark):
    seen = {}

    class Query:
        recentProgress = []

        def awaitTermination(self, every):
            return True

    def start(*args, **more):
        seen["trigger"] = args[7]
        return Query()

    monkeypatch.setattr(jobs.streams, "bronze_updates", start)
    args = jobs.parser().parse_args(["bronze-updates", "--topic", "t", "--path", "p", "--checkpoint", "c"])
    args.run(spark, args)
    assert seen["trigger"] == {"processingTime": "2 minutes"}


def test_bronze_can_be_laid_out_by_day():
    args = jobs.parser().parse_args(
        ["bronze-positions", "--topic", "t", "--path", "p", "--checkpoint", "c", "--partition-by", "start_date"]
    )
    assert args.partition_by == ["start_date"]


def test_formats_are_options():
    args = jobs.parser().parse_args(
        ["bronze-updates", "--topic", "t", "--path", "p", "--checkpoint", "c", "--servers", "h:9092", "--format", "delta"]
    )
    assert (args.topic_format, args.servers, args.format, args.once) == ("kafka", "h:9092", "delta", False)
