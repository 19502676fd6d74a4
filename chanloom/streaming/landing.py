"""Incremental ingestion of a playlist landing directory.

The original tool rebuilds everything on a schedule.  With Structured
Streaming the landing directory is a file source: each run sees only the
playlist files that arrived since the last run (the stream checkpoint
remembers them).  The stream carries file names only; ``foreachBatch`` reads
the newest file of every source of the batch with the batch operators, logs it
in the manifest (``sources.manifest``) and writes its entries.  A re-fetched playlist
must land under a new path (``<source>~<version>.m3u``): Spark's file source
does not pick up a known path again.  ``latest_entries`` follows the newest
manifest row of a source, so an emptied playlist has no entries left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import parse as P
from ..sources import manifest as M
from ..sources import readers as R

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def _entries_writer(landing_dir: str, entries_path: str, pattern: str, chunk_lines: int):
    def write(batch: DataFrame, epoch_id: int) -> None:
        spark, root = batch.sparkSession, f"{entries_path}/manifest"
        # files of no bytes give the stream no row: they come from a listing of what is new
        emptied = M.found_since(spark, root, landing_dir, pattern, before=epoch_id).where("length = 0")
        # One folder per batch, overwritten on retry: a re-run batch (the
        # sink is at-least-once) never duplicates entries.
        chosen = M.append(R.newest_files(batch.unionByName(emptied)), root, epoch_id)
        parsed = P.m3u_parse(R.chosen_lines(chosen, pattern), chunk_lines)
        parsed.write.mode("overwrite").partitionBy("source_name").parquet(f"{entries_path}/entries/batch={epoch_id}")
    return write


def ingest_playlists(spark: SparkSession, landing_dir: str, entries_path: str, checkpoint_location: str,
                     pattern: str = "*.m3u", chunk_lines: int = P.DEFAULT_CHUNK_LINES,
                     available_now: bool = True, files_per_batch: int = 10_000):
    """Start (and with ``available_now`` finish) one incremental ingest run.

    Returns the ``StreamingQuery``; call ``awaitTermination()`` on it.
    """
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
             .option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch)
             .option("recursiveFileLookup", "true").load(landing_dir))
    writer = (R.list_files(files).writeStream.foreachBatch(_entries_writer(landing_dir, entries_path, pattern, chunk_lines))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def latest_entries(spark: SparkSession, entries_path: str) -> DataFrame:
    """Entries of the newest file of every source (a re-fetched playlist
    replaces the previous one, an empty one removes it)."""
    newest = M.newest(spark, f"{entries_path}/manifest").select("source_name", F.col("batch_id").alias("batch"))
    return spark.read.parquet(f"{entries_path}/entries").join(newest, ["source_name", "batch"], "left_semi").drop("batch")
