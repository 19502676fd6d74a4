"""Outputs as versions: written beside the live one, then made current.

    <out>/versions/<number>-<id>/...   one build's playlists, tables, reports
    <out>/commits                      one row per complete version, appended last

A build that dies leaves a version that nobody reads; the one before stays
current.  Readers ask ``current`` once and read that folder.  ``prune``
removes versions that are neither current nor the few before it.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "number long, version string, committed_at timestamp"


def commits(spark: SparkSession, out_dir: str) -> DataFrame:
    try:
        return spark.read.schema(SCHEMA).parquet(f"{out_dir}/commits")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def _last(spark: SparkSession, out_dir: str):
    return commits(spark, out_dir).agg(F.max(F.struct("number", "committed_at", "version")).alias("c")).first()["c"]


def begin(spark: SparkSession, out_dir: str) -> str:
    """The folder of a new version."""
    last = _last(spark, out_dir)
    return f"{out_dir}/versions/{(last.number if last else 0) + 1:08d}-{uuid.uuid4().hex[:12]}"


def commit(spark: SparkSession, folder: str) -> None:
    """Make a complete version current: one appended row."""
    out_dir, version = folder.rsplit("/versions/", 1)
    row = spark.createDataFrame([(int(version.split("-")[0]), version)], "number long, version string").withColumn("committed_at", F.current_timestamp())
    row.coalesce(1).write.mode("append").parquet(f"{out_dir}/commits")


def current(spark: SparkSession, out_dir: str) -> str:
    """The folder of the current version."""
    last = _last(spark, out_dir)
    if last is None:
        raise FileNotFoundError(f"no complete version in {out_dir}")
    return f"{out_dir}/versions/{last.version}"


def prune(spark: SparkSession, out_dir: str, keep: int = 2) -> list[str]:
    """Delete versions (also unfinished ones) older than the last ``keep``
    complete ones; their names."""
    kept = commits(spark, out_dir).orderBy(F.desc("number"), F.desc("committed_at"), F.desc("version")).limit(max(1, keep)).collect()
    if not kept:
        return []
    names, oldest = {r.version for r in kept}, min(r.number for r in kept)
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{out_dir}/versions")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    # a newer number may be a build that still runs
    old = [s.getPath() for s in files.listStatus(root) if s.getPath().getName() not in names and int(s.getPath().getName().split("-")[0]) <= oldest]
    for path in old:
        files.delete(path, True)
    return sorted(p.getName() for p in old)
