"""Session settings every job and query of this package relies on."""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    # Every timestamp is UTC, whatever the zone of the machine.
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key is legal input; the last value wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    # Folders are listed by so many tasks at most, several each, and not by a task per folder.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # Streaming state on disk, so it may outgrow executor memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


# Settings of sessions built here, on top of the above.
BUILD_CONF = {
    "spark.ui.enabled": "false",
    # Recording the call site of every column expression takes longer than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_USER_SIZED = "vitals.shuffle.sized.by.user"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "vitals", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **BUILD_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster, for results that jobs run as queries leave behind.

    Without one, as in tests, it is the session's warehouse folder, which executors share too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return root.rstrip("/")


def checkpoint_for(lake_root: str, stream: str, target: str) -> str:
    """Checkpoint of one stream into one target, below the lake, where a restarted job finds it again."""
    digest = hashlib.sha256(target.encode()).hexdigest()[:16]
    return f"{lake_root.rstrip('/')}/_checkpoints/{stream}-{digest}"


def size_shuffles(spark: SparkSession, input_bytes: int, target_bytes: int = 128 << 20) -> int:
    """Start the shuffles of a job with a partition for every ``target_bytes`` of its input.

    Adaptive execution merges partitions that turn out small, but does not split an aggregation's that
    turn out large. A number set by the user is left alone.
    """
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if spark.conf.get(_USER_SIZED, None) is None:
        spark.conf.set(_USER_SIZED, str(spark.conf.get(_INITIAL_PARTITIONS, None) is not None).lower())
    if spark.conf.get(_USER_SIZED) == "false":
        spark.conf.set(_INITIAL_PARTITIONS, str(max(configured, -(-input_bytes // target_bytes))))
    return int(spark.conf.get(_INITIAL_PARTITIONS))
