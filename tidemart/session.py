"""Session settings the jobs are written for, and the folder shared by all executors."""

from __future__ import annotations

import atexit
import shutil
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
PARTITION_BYTES = 64 << 20
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
# Rows of words and counts take about 16 times their shuffled size in the hash tables of one task.
TASK_BYTES = 16 << 20

# Runtime settings. Sizes are per task, so they hold for any number of executors. AQE merges small shuffle
# partitions up to the advisory size but does not split those of aggregates and windows, so a large job
# must start from enough of them: give build_session the size of its input.
BATCH_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    ADVISORY: f"{TASK_BYTES}b",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even when the next operator then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Stream joins keep their four state tables in one store per partition.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    # The state channel of Python processors uses a socket file instead of a loopback port.
    "spark.python.unix.domain.socket.enabled": "true",
}


def build_session(app: str = "tidemart", master: str | None = None,
                  conf: dict[str, str] | None = None, input_bytes: int | None = None) -> SparkSession:
    """A session with the settings above; on a cluster leave ``master`` to spark-submit.

    ``input_bytes`` is the size of the job's input: shuffles start from one partition per
    ``PARTITION_BYTES`` of it. Streams keep ``spark.sql.shuffle.partitions``, which fixes their state.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum":
             str(max(200, input_bytes // PARTITION_BYTES))} if input_bytes else {}
    for key, value in {**BATCH_SETTINGS, **STREAM_SETTINGS, **sized, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def limit_task_bytes(spark: SparkSession, most: int = TASK_BYTES) -> None:
    """Let AQE merge shuffle partitions up to ``most`` bytes, or up to what is set where that is less."""
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(ADVISORY))
    if now > most:
        spark.conf.set(ADVISORY, f"{most}b")


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Apply runtime settings for one block and put the old values back afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Write a layer that several readers need to the shared folder, and read it from there."""
    path = shared_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    release(rows.sparkSession)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffles that no plan needs any more: it does when the driver's plans are collected.

    A driver with memory to spare may not do so for a whole job, whose layers then all keep their shuffles on disk.
    """
    spark._jvm.System.gc()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder for ``name`` below the shared folder that the cluster names.

    Without ``spark.checkpoint.dir`` a local session gets a folder of its own on this machine, as all its
    executors are on it, until it ends; any other session fails, as its executors would not see each other's files.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that the driver and all executors share")
        base = f"/tmp/tidemart-{uuid.uuid4().hex}"
        spark.conf.set(CHECKPOINT_DIR, base)
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/tidemart/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)
