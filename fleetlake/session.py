"""SparkSession construction and cluster-level settings.

All time arithmetic in this package assumes the session time zone is UTC:
bronze timestamps are instants and the hour buckets must not move with the
client's locale.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  Partition counts are left to AQE: the
# initial value is an upper bound that AQE coalesces at run time, so the
# same code runs on local[8] and on a 1000-executor cluster.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Preset for a large cluster (~100 TB inputs, ~1000 executors).  Shuffles
# start wide (16k partitions: ~100 TB of keys / 16k ~ a few GB before
# pre-aggregation, much less after) and AQE coalesces them towards 256 MB
# per task at run time; scans split at 256 MB; a partition counts as skewed
# at 5x the median and above 512 MB and is split by AQE (skew join and
# REBALANCE).  Broadcasts stay explicit and size-checked (see
# ``operators.drift.broadcast_if_bounded``); the automatic threshold only
# covers small dimension-like sides.
SCALE_CONF = {
    "spark.sql.shuffle.partitions": "16384",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16384",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "fleetlake",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    scale: bool = False,
) -> SparkSession:
    """Return a session with the package's base configuration applied
    (``scale=True`` adds ``SCALE_CONF`` for cluster-sized inputs)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if scale:
        conf.update(SCALE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # getOrCreate returns an existing session unchanged; apply the runtime
    # SQL settings explicitly so they hold either way.
    for key, value in conf.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is.  Only when it is unset (local tests) a scratch folder is
    created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="fleetlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written tables that cut lineage)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])
