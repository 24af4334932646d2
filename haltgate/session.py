"""Session construction and cluster-aware settings.

All operators assume the session time zone is UTC: epoch milliseconds and
window boundaries are then identical on every executor and in the oracle.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale; every one is a runtime Spark SQL conf.
SCALE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Parquet scans: keep input splits at 128 MiB so a task fits executor memory.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Window state of the streaming jobs on local disk, not in executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Context settings, fixed when the context starts: no web UI, and checkpoint
# files of DataFrames that are no longer referenced are removed (every
# foreachBatch micro-batch checkpoints its small state tables).
CONTEXT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "haltgate") -> SparkSession:
    """Local/test session. On a cluster the submitter's settings win: a
    ``SCALE_CONF`` key is set only when the submitted configuration
    (``--conf``, defaults file) does not name it. The session time zone is
    always UTC (see ``ensure_utc``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in CONTEXT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    submitted = spark.sparkContext.getConf()
    fill = dict(SCALE_CONF)
    if shuffle_partitions:
        fill["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in fill.items():
        if not submitted.contains(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("WARN")
    ensure_utc(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when the setting is absent (local tests) do we pick a scratch folder.
    """
    return ensure_checkpoint_dir(spark)


_CHECKPOINT_SET: dict[str, str] = {}


def configured_checkpoint_dir(spark: SparkSession) -> str | None:
    """``spark.checkpoint.dir`` of the session or its context, if set."""
    return (spark.conf.get("spark.checkpoint.dir", None)
            or spark.sparkContext.getConf().get("spark.checkpoint.dir", None))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Points the context's checkpoint folder at ``spark.checkpoint.dir``.

    The cluster names a shared folder there; a scratch folder is created only
    for a local master when the setting is absent (tests)."""
    key = spark.sparkContext.applicationId
    if key in _CHECKPOINT_SET:
        return _CHECKPOINT_SET[key]
    path = configured_checkpoint_dir(spark)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="haltgate-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    _CHECKPOINT_SET[key] = path
    return path


def state_dir(spark: SparkSession, name: str) -> str:
    """Sub-folder of the shared checkpoint dir for a streaming query or table."""
    return os.path.join(checkpoint_dir(spark), name)
