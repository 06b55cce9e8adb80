"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Safe to change on a running session. The forced skew split matters because a join on
# product_id already satisfies a later groupBy(..., product_id): without it Spark keeps a
# hot product in one task to save the second exchange.
# Log times are UTC, so times are parsed, windowed and dated in UTC.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Streaming state lives in RocksDB so it can spill; changelog checkpointing uploads only deltas.
STREAMING_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # The total of rows is only reported, and would cost a look into the state for every row written.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # Of several sources the fastest decides, so one that has gone quiet holds nothing back.
    "spark.sql.streaming.multipleWatermarkPolicy": "max",
}

# Reliable checkpoints go when the frame they belong to is no longer referenced.
CONTEXT_SETTINGS = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


def build_session(app: str = "basketflow", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        **RUNTIME_SETTINGS,
        **STREAMING_SETTINGS,
        **CONTEXT_SETTINGS,
        **(extra or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def streaming_session(spark: SparkSession) -> SparkSession:
    """A sibling session carrying the state-store settings, so the caller's stay untouched."""
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.shuffle.partitions",
                     spark.conf.get("spark.sql.shuffle.partitions"))
    for key, value in {**RUNTIME_SETTINGS, **STREAMING_SETTINGS}.items():
        sibling.conf.set(key, value)
    return sibling


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Where none is set, a local run gets a fresh folder and anything else is refused: executors
    on other machines would write to disks of their own.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") \
        or spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not configured and not is_local(context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="basketflow-"))
    return configured or context.getCheckpointDir()


def is_local(master: str) -> bool:
    """One machine, one JVM: driver and executors see the same disk."""
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/basketflow/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove every scratch table of this application."""
    delete_path(spark, _scratch_root(spark))


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def delete_path(spark: SparkSession, path: str) -> None:
    system, target = file_system(spark, path)
    system.delete(target, True)
