"""Reading what a build has published: channels and playlists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tiers as T
from ..operators.search_index import read_channels  # noqa: F401  (the published table)

#: Where a playlist's parts are, and the name it has.
PARTS = r"/(all|by-category-all|by-country-all)\.m3u\.parts/[^/]+$"
FOLDERS = r"/(by-country|by-category)/(?:country|category)=([^/]*)/[^/]+$"


def read_playlists(spark: SparkSession, folder: str) -> DataFrame:
    """(playlist, line_no, line): every line of every playlist of one output
    folder, in order.  Part files are read in blocks and numbered by their
    rank, so no playlist is one task."""
    paths = [f"{folder}/{name}" for name in ("all.m3u.parts", "by-category-all.m3u.parts", "by-country-all.m3u.parts", "by-country", "by-category")]
    raw = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(paths)
    path = F.try_url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    lines = raw.select(path.alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    # partition values are escaped once more in folder names
    group = F.try_url_decode(F.replace(F.regexp_extract("file", FOLDERS, 2), F.lit("+"), F.lit("%2B")))
    whole = F.regexp_extract("file", PARTS, 1)
    name = F.when(whole != "", whole).otherwise(F.concat(F.regexp_extract("file", FOLDERS, 1), F.lit("/"), group))
    ranked = T.with_rank(lines.withColumn("playlist", name), [F.col(c) for c in ("playlist", "file", "block", "at")])
    first = ranked.groupBy("playlist").agg(F.min("rank").alias("first"))
    return ranked.join(first, "playlist").select("playlist", (F.col("rank") - F.col("first") + 1).alias("line_no"), "line")
