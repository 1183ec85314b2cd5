"""Spark session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of this package assumes.  Broadcast joins are only
# chosen by AQE from *measured* shuffle sizes (the static, estimate-based
# threshold is off), skewed join partitions are split at runtime and small
# post-shuffle partitions are coalesced.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # keep CPU-heavy stages over small shuffles on every core (merging only
    # below 64 KB); large shuffles are sized by the advisory size
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Added for large clusters (``profile="cluster"``).  Shuffles start with many
# partitions and AQE merges them up to the advisory size (size first, not
# parallelism first), so a 100 TB shuffle gets ~256 MB partitions instead of a
# fixed count sized for another data volume; skewed join partitions above
# 5x the median and 1 GB are split.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "65536",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1GB",
    "spark.sql.files.maxPartitionBytes": "512MB",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "orderflow", extra: dict | None = None,
              profile: str = "local") -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster ``master`` stays ``None`` and the launcher decides;
    ``profile="cluster"`` adds :data:`CLUSTER_CONF`.  The checkpoint folder
    is read from ``spark.checkpoint.dir``; only a local session without one
    gets a private folder under the system temp dir.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """Folder visible to every executor, taken from ``spark.checkpoint.dir``.

    A local session (tests, single-node bench) without the setting gets a
    fresh private temp folder; a cluster session without it is an error,
    because a machine-local folder would not survive executor loss.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        d = tempfile.mkdtemp(prefix="orderflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new sub-path of the shared folder (never reused between calls)."""
    base = shared_dir(spark)
    if base.startswith("file:") or "://" not in base:
        local = base[5:] if base.startswith("file:") else base
        os.makedirs(local, exist_ok=True)
        return tempfile.mkdtemp(prefix=f"{name}-", dir=local)
    import uuid
    return f"{base}/{name}-{uuid.uuid4().hex}"
