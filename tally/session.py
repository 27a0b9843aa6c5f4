"""Spark session factory.

Every report assumes the settings made here: session time zone pinned to UTC
(instants are stored as UTC ``timestamp_ntz``), ANSI mode on (bad casts and
overflow raise instead of silently turning into NULL), and adaptive query
execution on, so that join strategy, skew splitting and partition coalescing
are decided on runtime sizes rather than guessed up front.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every report depends on (semantics, not tuning).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Execution defaults; a cluster's own values win when already set (see build_session).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast bounds: at planning time only sides whose scanned file bytes
    # are under 10 MB (Spark's default); at runtime AQE may also broadcast a
    # side whose *measured* shuffle output is under 32 MB. Anything larger
    # is shuffled, with AQE splitting skewed partitions.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Remove checkpoint files once their DataFrame is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Streaming state (one row per ledger transaction) off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app_name: str = "tally",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or fetch) a session configured for the reports.

    ``DEFAULT_CONF`` values apply only where the cluster (spark-defaults,
    ``--conf``) has not set the key; ``extra_conf`` and ``shuffle_partitions``
    are explicit and always apply; ``REQUIRED_CONF`` always applies.
    """
    from pyspark import SparkConf

    cluster = SparkConf()          # spark-defaults and submit-time settings
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {k: v for k, v in DEFAULT_CONF.items() if not cluster.contains(k)}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    conf.update(REQUIRED_CONF)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the reports rely on to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only when the setting is absent and the master is one local JVM (tests) is a
    scratch folder created; on a cluster without the setting it raises rather
    than checkpoint to a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:                       # already set on the context (by conf or code)
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder every executor "
                           "shares (HDFS, object store); a machine-local folder would be "
                           "lost with its executor")
    local = tempfile.mkdtemp(prefix="tally-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local
