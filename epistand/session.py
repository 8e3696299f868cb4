"""Spark session settings used by the library, the tests and the benchmark.

Everything here is plain configuration: AQE on (runtime coalescing, skew-join splitting and
size-checked broadcast conversion), UTC session time zone, UI off, and a checkpoint folder that
is only set when the cluster has not already named one.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Joins against lookups are left to AQE: it measures the shuffled size of each side at run time
# and turns the join into a broadcast only below this bound, keeping the sort-merge join above it.
BROADCAST_BYTES = 64 * 1024 * 1024


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "epistand",
                  extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", str(BROADCAST_BYTES))
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only when none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is; a local scratch
    folder is only created for local runs such as the tests; any other master without one is an
    error, as its executors would write to their own disks.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder shared by the cluster (master {master})")
        current = tempfile.mkdtemp(prefix="epistand-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current
