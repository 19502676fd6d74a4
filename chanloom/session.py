"""Spark session helpers.

The engine never owns the cluster configuration: on a cluster the session
is given to us and we only read from it.  ``get_spark`` is for tests, the
bench and local runs, and only fills settings that are unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators rely on for exact results.  They are session
# scoped SQL confs, so they are safe to set on a shared session.
REQUIRED_SQL_CONF = {
    # Attribute maps: a repeated key keeps its last value (playlist rule).
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.session.timeZone": "UTC",
}

# Defaults for local runs.  On a cluster the operator sets these itself.
LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def apply_required_conf(spark: SparkSession) -> SparkSession:
    for key, value in REQUIRED_SQL_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "chanloom") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app_name)
    for key, value in LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_required_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; without it a cluster run is refused, since executors would write
    to their own disks.  A local run (one machine) gets a fresh scratch
    folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="chanloom-ckpt-", dir="/tmp")
    sc.setCheckpointDir(folder)
    return folder


def materialize(df):
    """Write a stage boundary to the session's checkpoint folder and cut its
    lineage.  Used where a DataFrame is read by several later joins (so it is
    computed once) and to make long jobs restartable after executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
