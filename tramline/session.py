"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    # Epoch seconds and schedule times are UTC instants; the zone must not depend on the host.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Twice the defaults: at 100 TB they would mean 800,000 scan tasks and as many merged partitions.
    # Small inputs are still divided between all slots.
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Checkpointed statistics go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

STREAM_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Join state of a busy network outgrows the heap; keep it on executor disk with changelog uploads.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Needed for the ``delta`` format, together with its package on the classpath.
DELTA_CONF = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}

# Shuffles start with this many partitions per task slot and are merged to what the data needs.
PARTITIONS_PER_SLOT = 8
MIN_PARTITIONS = 200
# A shuffle of more rows than this per partition starts with more, up to a number the shuffle
# itself can still handle.
ROWS_PER_PARTITION = 5_000_000
MAX_PARTITIONS = 64_000

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def get_session(app_name: str, conf: dict[str, str] | None = None) -> SparkSession:
    """Session for a job. The master is chosen at submit time, never here.

    Unless the caller sizes shuffles, they follow the cluster: 8,000 slots start with 64,000
    partitions, about 1.5 GB each for 100 TB, and small inputs are merged back to a few.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.getConf().contains("spark.sql.shuffle.partitions"):
        wanted = min(MAX_PARTITIONS, task_slots(spark) * PARTITIONS_PER_SLOT)
        spark.conf.set(INITIAL_PARTITIONS, str(max(MIN_PARTITIONS, wanted)))
    return spark


def task_slots(spark: SparkSession) -> int:
    """Tasks that can run at once; with dynamic allocation, when it has grown to its limit."""
    context, conf = spark.sparkContext, spark.sparkContext.getConf()
    slots = context.defaultParallelism
    limit = conf.get("spark.dynamicAllocation.maxExecutors")
    if limit and conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        slots = max(slots, int(limit) * int(conf.get("spark.executor.cores", "1")))
    return slots


def raise_partitions(spark: SparkSession, rows: int) -> None:
    """Let shuffles of this many rows start with enough partitions.

    Adaptive execution merges partitions but never adds any, so a session left at its default
    would put billions of rows into each. The number is only ever raised.
    """
    wanted = min(MAX_PARTITIONS, -(-rows // ROWS_PER_PARTITION))
    given = spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")
    if wanted > int(given):
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """Sibling session for stateful streams, so their settings do not leak into batch queries.

    The number of state partitions is frozen by the first checkpoint. By default it is the
    configured number of shuffle partitions, or else one wave of tasks.
    """
    session = spark.newSession()
    for key, value in STREAM_CONF.items():
        session.conf.set(key, value)
    configured = spark.sparkContext.getConf().get("spark.sql.shuffle.partitions")
    session.conf.set("spark.sql.shuffle.partitions", str(state_partitions or configured or task_slots(spark)))
    return session


def state_partitions(spark: SparkSession) -> int:
    """Partitions that a stream first started in this session deals its state to."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def work_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables: ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, since executors elsewhere could not
    see it.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="tramline-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run, under the shared folder."""
    return f"{work_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
