"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here relies on. The time zone is pinned so that
# timestamp <-> instant conversions (streams need instants for watermarks)
# agree with the wall-clock TIMESTAMP_NTZ columns of the tables.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Suggested additions for a large cluster (100 TB inputs, ~1000 executors).
# Shuffle partitions start high and AQE coalesces them to ~256 MB each, so
# a stage never has partitions that outgrow executor memory; input splits
# stay at 256 MB; skewed shuffle partitions are split; streaming state goes
# to RocksDB (off-heap, spills to local disk, checkpointed to the shared
# checkpoint folder) instead of the JVM heap.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Streams keep their number of shuffle partitions for the life of a checkpoint
# and do not coalesce them (adaptive execution is off inside micro-batches), so
# a stream session takes few partitions instead of the batch value above.
STREAM_CONF = {**CLUSTER_CONF, "spark.sql.shuffle.partitions": "200"}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "flowscope", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the library expects.

    On a cluster pass neither ``master`` nor ``shuffle_partitions``: the
    launcher decides the master; pass ``extra=CLUSTER_CONF`` (or the
    launcher's own values) for shuffle sizing and the streaming state store.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.ui.enabled", "false")
        conf.setdefault("spark.ui.showConsoleProgress", "false")
        conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder visible to every executor, taken from ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is only read here.
    When it is unset on a local master (tests) a fresh local folder is created
    once and registered as the context's checkpoint folder, so later calls in
    the same session reuse it; on any other master that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="flowscope-ckpt-"))
        path = spark.sparkContext.getCheckpointDir()
    return path.rstrip("/")


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A new, unique sub-path of the shared folder (never reused, never cleared)."""
    base = shared_dir(spark)
    return f"{base}/{kind}-{uuid.uuid4().hex[:12]}"


def is_local_path(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


def ensure_dir(path: str) -> None:
    if is_local_path(path):
        os.makedirs(path.replace("file:", ""), exist_ok=True)


def stage(df, kind: str = "stage"):
    """Write ``df`` once as parquet under the shared folder and return a scan of it.

    Used where one intermediate (e.g. a keyed window aggregate) feeds several
    consumers: they read the stored table instead of re-running the scan and
    shuffles of the input, and the lineage is cut (a lost executor costs a
    re-read, not a recomputation from the raw input).
    """
    spark = df.sparkSession
    path = fresh_path(spark, kind)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
