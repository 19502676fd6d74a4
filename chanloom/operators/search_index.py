"""Catalogue search by trigram postings.

The postings (gram, rank) of every published channel are written beside the
channels, both partitioned by country and tier and the postings sorted by
gram.  A search reads the postings of its text's trigrams only (partitions
by country and tier, row groups by gram), keeps the channels that have all of
them, and verifies those with the same predicate as a scan.  Texts of fewer
than three characters are scanned for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .search import haystack, search_predicate

GRAM = 3
#: Stated, so that partition values keep their text ("01" is no number).
CHANNELS = ("rank long, name string, url string, source_name string, source_weight int, source_tags array<string>, group_title string, country string, "
            "categories array<string>, alive boolean, status_code int, latency_ms int, check_error string, check_level int, tier string, score double, "
            "tvg_id string, tvg_name string, tvg_logo string")
POSTINGS = "gram string, rank long, country string, tier string"


def read_channels(spark: SparkSession, folder: str) -> DataFrame:
    """The published table of an output folder."""
    return spark.read.schema(CHANNELS).parquet(f"{folder}/channels.parquet")


def postings(channels: DataFrame) -> DataFrame:
    """(country, tier, gram, rank) of every channel with a ``rank``."""
    text = haystack()
    grams = F.transform(F.sequence(F.lit(1), F.length(text) - GRAM + 1), lambda i: F.substring(text, i, F.lit(GRAM)))
    held = channels.where(F.length(text) >= GRAM)
    return held.select("country", "tier", F.explode(F.array_distinct(grams)).alias("gram"), "rank")


def write_postings(channels: DataFrame, path: str) -> None:
    rows = postings(channels)
    keys = ["country", "tier", "gram"]
    # a gram of many channels is cut by rank
    rows.repartitionByRange(*keys, "rank").sortWithinPartitions(*keys, "rank").write.mode("overwrite").partitionBy("country", "tier").parquet(path)


def _in(df: DataFrame, country: str | None, tier: str | None) -> DataFrame:
    df = df.where(F.col("country") == country) if country else df
    return df.where(F.col("tier") == tier) if tier else df


def catalogue_search(spark: SparkSession, folder: str, text: str | None = None, country: str | None = None,
                     category: str | None = None, tier: str | None = None) -> DataFrame:
    """``search.catalogue_search`` over an output folder, by its index."""
    channels = _in(read_channels(spark, folder), country, tier)
    asked = (text or "").strip().lower()
    if len(asked) >= GRAM:
        grams = sorted({asked[i: i + GRAM] for i in range(len(asked) - GRAM + 1)})
        found = _in(spark.read.schema(POSTINGS).parquet(f"{folder}/channels.index"), country, tier).where(F.col("gram").isin(grams))
        whole = found.groupBy("rank").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(grams)).select("rank")
        channels = channels.join(whole, "rank", "left_semi")
    return channels.where(search_predicate(text, country, category, tier))
