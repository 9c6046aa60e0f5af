"""The stream's join with a routing that follows keys which turn hot after its start.

Which part of a key a row goes to is a function of its key and its event time. At each start the bronze
files that came since the last one are counted by key cell and window; counts merge with the earlier ones.
A cell that has outgrown its parts gets more, as a new generation of the routing, from an event time on
that no row in the join's state can reach: later than its last processed row by more than the bound. So
what the state holds was routed as it would be now, every pair meets in one task, and the outer join stays
exact across any number of changes.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tramline.functions import JOIN_KEYS, time_slot
from tramline.operators import skew
from tramline.operators.fact import BOUND_SECONDS, POSITION_COLUMNS, UPDATE_COLUMNS, clean_positions, clean_updates
from tramline.schemas import BRONZE_TRIP_UPDATE, ROUTE, ROUTE_COUNT, VEHICLE_POSITION, Columns, ddl
from tramline.session import state_partitions
from tramline.sources.commits import CommitLog, new_files, new_run
from tramline.sources.tables import append_stream, read_table, stream_table, with_source_row
from tramline.streaming.jobs import LATENESS_SECONDS, both_sides_split, timed

ALWAYS, NEVER = -(1 << 62), 1 << 62


def processed_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """item: the files a stream over plain files has planned in any batch, from its checkpoint; none before its start."""
    try:
        lines = spark.read.text(f"{checkpoint.rstrip('/')}/sources/*")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "item string")
    path = F.get_json_object("value", "$.path")
    return lines.filter(F.col("value").startswith("{")).select(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))).alias("item"))


class Routing:
    """The generations of a stream's routing and the counts they come from, kept next to its checkpoint."""

    def __init__(self, spark: SparkSession, checkpoint: str, bound: int = BOUND_SECONDS) -> None:
        self.spark, self.checkpoint, self.bound = spark, checkpoint, bound
        self.path = f"{checkpoint.rstrip('/')}-routing"
        self.log = CommitLog(spark, f"{self.path}/log")

    def _kept(self, name: str, columns: Columns, runs: list[str]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], ddl(columns))
        stored = read_table(self.spark, f"{self.path}/{name}", columns={**columns, "run": "string"})
        return stored.filter(F.col("run").isin(runs)).select(*columns)

    def _counts(self, positions: DataFrame, updates: DataFrame) -> DataFrame:
        """Rows of each side per cell and window of the length the state holds, and the last event time."""
        width = 2 * (self.bound + LATENESS_SECONDS)
        sides = []
        for rows, time, left in (
            (clean_positions(positions), "vehicle_timestamp", 1),
            (clean_updates(updates), "ingested_at", 0),
        ):
            at = F.unix_micros(time)
            sides.append(
                rows.filter(F.col(time).isNotNull()).select(
                    skew.cell(JOIN_KEYS).alias("cell"),
                    time_slot(at, width).alias("slot"),
                    F.lit(left).alias("left"),
                    F.lit(1 - left).alias("right"),
                    at.alias("at"),
                )
            )
        return sides[0].unionAll(sides[1]).groupBy("cell", "slot").agg(
            F.sum("left").alias("left_rows"), F.sum("right").alias("right_rows"), F.max("at").alias("latest")
        )

    def _of_files(self, path: str, columns: Columns, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], ddl(columns))
        return self.spark.read.schema(ddl(columns)).option("basePath", path).parquet(*files)

    def follow(
        self, positions_path: str, updates_path: str, rows_per_task: int = skew.ROWS_PER_TASK
    ) -> int:
        """Count new files and add a generation for cells that outgrew their parts; returns how many cells did.

        To be called while the stream is stopped.
        """
        tables = {positions_path: VEHICLE_POSITION, updates_path: BRONZE_TRIP_UPDATE}
        fresh = {p: new_files(read_table(self.spark, p, columns=c), self.log) for p, c in tables.items()}
        names = sum(fresh.values(), [])
        if not names:
            return 0
        done = processed_files(self.spark, self.checkpoint)
        listed = self.spark.createDataFrame([(name,) for name in names], "item string")
        seen = {row["item"] for row in listed.join(done, "item", "left_semi").collect()}
        run, before = new_run("route"), self.log.runs()
        parts = []
        for processed in (True, False):
            rows = [self._of_files(p, c, [f for f in fresh[p] if (f in seen) == processed]) for p, c in tables.items()]
            parts.append(self._counts(*rows).withColumn("processed", F.lit(processed)))
        parts[0].unionByName(parts[1]).select(*ROUTE_COUNT).write.parquet(f"{self.path}/counts/run={run}")

        # What earlier starts have counted may all have been processed since.
        earlier = self._kept("counts", ROUTE_COUNT, before).withColumn("processed", F.lit(True))
        now = read_table(self.spark, f"{self.path}/counts/run={run}", columns=ROUTE_COUNT)
        merged = earlier.unionByName(now).groupBy("cell", "slot").agg(
            F.sum("left_rows").alias("left_rows"),
            F.sum("right_rows").alias("right_rows"),
            F.max(F.when(F.col("processed"), F.col("latest"))).alias("latest"),
        )
        cells = skew.stored(
            merged.groupBy("cell").agg(
                F.max("left_rows").alias("left_rows"), F.max("right_rows").alias("right_rows"), F.max("latest").alias("latest")
            )
        )
        hot = skew.plan_split(cells, rows_per_task, tasks=state_partitions(self.spark)).hot
        grown = self._grown(cells, hot, len(before) + 1) if hot is not None else self.spark.createDataFrame([], ddl(ROUTE))
        grown.write.parquet(f"{self.path}/routes/run={run}")
        self.log.commit(run, names)
        return read_table(self.spark, f"{self.path}/routes/run={run}", columns=ROUTE).count()

    def _grown(self, cells: DataFrame, hot: DataFrame, generation: int) -> DataFrame:
        """The cells that need more parts than they have, and from when they have them; parts never become fewer."""
        has = self.routes().groupBy("cell").agg(F.max("left_parts").alias("has_left"), F.max("right_parts").alias("has_right"))
        wanted = hot.join(has, "cell", "left").na.fill(1, ["has_left", "has_right"])
        wanted = wanted.filter("left_parts > has_left OR right_parts > has_right").join(cells.select("cell", "latest"), "cell")
        since = F.coalesce(F.col("latest") + (self.bound + 1) * 1_000_000, F.lit(ALWAYS))
        return wanted.select(
            "cell",
            since.alias("since"),
            F.greatest("left_parts", "has_left").alias("left_parts"),
            F.greatest("right_parts", "has_right").alias("right_parts"),
            F.lit(generation).alias("generation"),
        )

    def routes(self) -> DataFrame:
        """cell, since (epoch microseconds), left_parts, right_parts, generation of every change."""
        return self._kept("routes", ROUTE, self.log.runs())

    def schedule(self) -> DataFrame:
        """cell and its entries (since, until, left_parts, right_parts); at most ``skew.CELLS`` rows."""
        order = W.partitionBy("cell").orderBy("generation")
        until = F.coalesce(F.lead("since").over(order), F.lit(NEVER)).alias("until")
        rows = self.routes().select("cell", "since", until, "left_parts", "right_parts")
        return rows.groupBy("cell").agg(F.collect_list(F.struct("since", "until", "left_parts", "right_parts")).alias("entries"))


def _most(side: str, first: Column, last: Column) -> Column:
    """The most parts of a side at any time between two instants; one where nothing is scheduled."""
    valid = F.filter("entries", lambda e: (e["since"] <= last) & (e["until"] > first))
    return F.greatest(F.lit(1), F.array_max(F.transform(valid, lambda e: e[f"{side}_parts"])))


def routed(rows: DataFrame, schedule: DataFrame, time: str, side: str, bound: int) -> DataFrame:
    """``rows`` with their own part, and the parts of the other side that rows in reach of them may be in."""
    other, reach, at = "right" if side == "left" else "left", bound * 1_000_000, F.unix_micros(time)
    marked = rows.withColumn("cell", skew.cell(JOIN_KEYS)).join(F.broadcast(schedule), "cell", "left")
    part = F.pmod(F.xxhash64(*rows.columns), _most(side, at, at)).cast("int")
    return marked.withColumns({f"{side}_part": part, f"{other}_parts": _most(other, at - reach, at + reach)})


def adaptive_fact(positions: DataFrame, updates: DataFrame, schedule: DataFrame, bound: int = BOUND_SECONDS) -> DataFrame:
    """``stream_fact`` under a schedule. Its state keeps its form whatever the schedule holds."""
    left = clean_positions(positions).filter(F.col("vehicle_timestamp").isNotNull())
    right = clean_updates(updates).filter(F.col("ingested_at").isNotNull())
    left = routed(left, schedule, "vehicle_timestamp", "left", bound)
    right = routed(right, schedule, "ingested_at", "right", bound)
    left = timed(left, [*POSITION_COLUMNS, "left_part", "right_parts"])
    right = timed(right, [*JOIN_KEYS, *UPDATE_COLUMNS, "right_part", "left_parts"])
    return both_sides_split(left, right, bound, [*JOIN_KEYS, "left_part"])


def silver_fact_adaptive(
    spark: SparkSession,
    positions_path: str,
    updates_path: str,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    bound: int = BOUND_SECONDS,
    rows_per_task: int = skew.ROWS_PER_TASK,
    options: dict | None = None,
) -> StreamingQuery:
    """``silver_fact`` over plain files whose split is looked at again at each start.

    A long run follows keys only when it is started again; positions are kept in the state twice. The
    checkpoint must have been begun by this function.
    """
    routing = Routing(spark, checkpoint, bound)
    routing.follow(positions_path, updates_path, rows_per_task)
    positions = with_source_row(stream_table(spark, positions_path, VEHICLE_POSITION, "parquet", options))
    updates = with_source_row(stream_table(spark, updates_path, BRONZE_TRIP_UPDATE, "parquet", options))
    # Planned once per start: the stream must not see a later generation half-way.
    schedule = skew.stored(routing.schedule())
    return append_stream(adaptive_fact(positions, updates, schedule, bound), path, checkpoint, trigger=trigger).start()
