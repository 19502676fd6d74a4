"""An append-only log of playlist files, with snapshots.

    <root>/log/epoch=E/batch=B   files that batch B found
    <root>/snapshots/epoch=E     the newest file of every source before epoch E
    <root>/epochs                one row per complete snapshot, written last

A batch is one folder, overwritten when it runs again, so a retry never adds
rows twice.  The first batch of an epoch writes the snapshot before it.  A
reader takes the last complete snapshot and the log of its epoch, so what it
lists and reads does not grow with the age of the log.

New files are found by their modification time: only those from ``LATE``
before the newest known file on are looked at (a file that lands with an
older time is not seen; ``late`` sets another span).  Batches must be
appended one at a time, with growing numbers.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .readers import newest_files, playlist_files

SCHEMA = "source_name string, file string, modified timestamp, length long, batch_id long"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
#: Batches of an epoch.
EPOCH = 50
LATE = timedelta(days=7)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    columns = [c.split()[0] for c in schema.split(", ")]
    try:
        return spark.read.schema(schema).parquet(path).select(*columns)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _epoch(spark: SparkSession, root: str) -> int:
    """The epoch of the last complete snapshot."""
    return _read(spark, f"{root}/epochs", "epoch long").agg(F.max("epoch")).first()[0] or 0


def newest(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """The newest file of every source (the last modified, of equals the last
    by path), with the batch that found it; ``before``: as it was known
    before that batch."""
    epoch = _epoch(spark, root)
    rows = _read(spark, f"{root}/snapshots/epoch={epoch}", SCHEMA).unionByName(_read(spark, f"{root}/log/epoch={epoch}", SCHEMA))
    return newest_files(rows if before is None else rows.where(F.col("batch_id") < before), ("batch_id",))


def append(rows: DataFrame, root: str, batch_id: int) -> DataFrame:
    """Log the files (source_name, file, modified, length) of a batch and
    return the written rows."""
    spark = rows.sparkSession
    # before anything is overwritten: they may have been found with the help of this log
    rows = materialize(rows.withColumn("batch_id", F.lit(batch_id).cast("long")).select(*COLUMNS))
    epoch, known = batch_id // EPOCH, _epoch(spark, root)
    if epoch > known:
        newest(spark, root).select(*COLUMNS).write.mode("overwrite").parquet(f"{root}/snapshots/epoch={epoch}")
        spark.createDataFrame([(epoch,)], "epoch long").coalesce(1).write.mode("append").parquet(f"{root}/epochs")
    path = f"{root}/log/epoch={epoch}/batch={batch_id}"
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


def found_since(spark: SparkSession, root: str, landing_dir: str, pattern: str = "*.m3u", late: timedelta = LATE, before: int | None = None) -> DataFrame:
    """Files in the landing folder that the log may not have yet."""
    known = newest(spark, root, before)
    span = F.make_dt_interval(secs=F.lit(late.total_seconds()))
    since = known.agg(F.date_format(F.max("modified") - span, "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
    files = playlist_files(spark, landing_dir, pattern, modified_after=since)
    return files.join(known.select("file", "modified"), ["file", "modified"], "left_anti").select("source_name", "file", "modified", "length")


def refresh(spark: SparkSession, root: str, landing_dir: str, pattern: str = "*.m3u", late: timedelta = LATE) -> DataFrame:
    """Log what has landed since the last batch; the newest file of every
    source."""
    last = newest(spark, root).agg(F.max("batch_id")).first()[0]
    fresh = materialize(newest_files(found_since(spark, root, landing_dir, pattern, late)))
    if not fresh.isEmpty():
        append(fresh, root, 0 if last is None else last + 1)
    return newest(spark, root)
