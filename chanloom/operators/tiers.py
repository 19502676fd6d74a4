"""Tiers, ranking, group titles and the published record."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Profile
from ..functions.text import title_case
from .classify import attr


def tier_label() -> Column:
    """Fixed thresholds of the published record: >=2 strict, >=1 relaxed."""
    lvl = F.coalesce(F.col("check_level"), F.lit(0))
    return F.when(lvl >= 2, "strict").when(lvl >= 1, "relaxed").otherwise("dead")


def with_tier(df: DataFrame) -> DataFrame:
    return df.withColumn("tier", tier_label())


def tier_filter(df: DataFrame, tier: str, profile: Profile) -> DataFrame:
    """strict: level >= strict_min; relaxed: level >= relaxed_min (overlaps
    strict); dead: level < relaxed_min."""
    lvl = F.coalesce(F.col("check_level"), F.lit(0))
    if tier == "strict":
        return df.where(lvl >= profile.strict_min_level)
    if tier == "relaxed":
        return df.where(lvl >= profile.relaxed_min_level)
    if tier == "dead":
        return df.where(lvl < profile.relaxed_min_level)
    raise ValueError(f"unknown tier {tier!r}")


def rank_order() -> list[Column]:
    """Score desc, country, lower-case name, then the pre-swap URL (the
    order the entries had before the stable tier sort)."""
    return [F.col("score_dec").desc(), F.col("country"), F.lower(F.col("name")), F.col("primary_url")]


def with_rank(df: DataFrame, keys: list[Column] | None = None, name: str = "rank",
              partitions: int | None = None) -> DataFrame:
    """Dense 1-based position in ``keys`` order (default ``rank_order``)
    without a single-task window.

    Range-partition and sort, give each row its index inside its partition
    and add the row count of all earlier partitions.  Only one count per
    partition is gathered and broadcast (bounded by the partition count).
    The sorted rows are checkpointed so both uses see the same partitions.
    """
    from pyspark.sql.window import Window

    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = keys or rank_order()
    sorted_df = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                 .withColumn("_pid", F.spark_partition_id())
                 .withColumn("_mid", F.monotonically_increasing_id()))
    sorted_df = sorted_df.checkpoint(eager=True)
    counts = sorted_df.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (sorted_df.join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
            .withColumn(name, (F.col("_off") + local + 1).cast("long"))
            .drop("_pid", "_mid", "_off"))


def title_lookup(titles: Mapping[str, str], key: Column, default: Column) -> Column:
    """Literal map look-up (titles are configuration) with a default."""
    if not titles:
        return default
    pairs = []
    for k, v in titles.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), default)


def group_title_column(country_titles: Mapping[str, str], category_titles: Mapping[str, str]) -> Column:
    """``"<country title or Other> | <first category title or its .title()>"``,
    ``General`` when there is no category."""
    country = title_lookup(country_titles, F.col("country"), F.lit("Other"))
    first = F.get(F.col("categories"), 0)
    category = F.when(first.isNull(), F.lit("General")).otherwise(
        title_lookup(category_titles, first, title_case(first)))
    return F.concat_ws(" | ", country, category)


def assign_group_title(df: DataFrame, profile: Profile) -> DataFrame:
    return df.withColumn("group_title",
                         group_title_column(profile.country_titles(), profile.category_titles()))


PUBLISHED_COLUMNS = [
    "name", "url", "source_name", "source_weight", "source_tags", "group_title", "country",
    "categories", "alive", "status_code", "latency_ms", "check_error", "check_level", "tier",
    "score", "tvg_id", "tvg_name", "tvg_logo",
]


def published(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The 18-field published record (plus ``extra`` columns, e.g. rank)."""
    if "tier" not in df.columns:
        df = with_tier(df)
    return df.select(
        *extra, "name", "url", "source_name", "source_weight", "source_tags", "group_title", "country",
        "categories", "alive", "status_code", "latency_ms", "check_error", "check_level", "tier",
        "score",
        attr("tvg-id").alias("tvg_id"), attr("tvg-name").alias("tvg_name"),
        attr("tvg-logo").alias("tvg_logo"))
