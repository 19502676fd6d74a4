"""Verification, audit and build reports.

All reports are aggregates over the tier DataFrames; one-row totals are a
single ``agg`` with ``count_if`` so each is one pass over its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Profile
from .tiers import published, rank_order


def _lvl():
    return F.coalesce(F.col("check_level"), F.lit(0))


def verification_totals(checked: DataFrame, profile: Profile) -> DataFrame:
    """total_checked, strict_total, relaxed_total, dead_total (one row)."""
    lvl = _lvl()
    return checked.agg(
        F.count(F.lit(1)).alias("total_checked"),
        F.count_if(lvl >= profile.strict_min_level).alias("strict_total"),
        F.count_if(lvl >= profile.relaxed_min_level).alias("relaxed_total"),
        F.count_if(lvl < profile.relaxed_min_level).alias("dead_total"),
    )


def failure_reasons(dead: DataFrame) -> DataFrame:
    """Count of dead entries per non-empty error, most common first."""
    return (dead.where(F.coalesce(F.col("check_error"), F.lit("")) != "")
            .groupBy("check_error").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), F.col("check_error")))


def country_counts(relaxed: DataFrame) -> DataFrame:
    return relaxed.groupBy("country").agg(F.count(F.lit(1)).alias("n"))


def category_counts(relaxed: DataFrame) -> DataFrame:
    """Entries per category; an entry without categories counts as general."""
    cats = F.when(F.size(F.coalesce(F.col("categories"), F.array())) > 0, F.col("categories")) \
        .otherwise(F.array(F.lit("general")))
    return (relaxed.select(F.explode(cats).alias("category"))
            .groupBy("category").agg(F.count(F.lit(1)).alias("n")))


def country_list(relaxed: DataFrame, country: str = "az") -> DataFrame:
    """Full published list of one country (audit)."""
    return published(relaxed.where(F.col("country") == country))


def other_examples(relaxed: DataFrame, limit: int = 120) -> DataFrame:
    """First ``limit`` 'other' entries in rank order (a top-k, not a sort)."""
    return published(relaxed.where(F.col("country") == "other").orderBy(*rank_order()).limit(limit))


def build_stats(sources: DataFrame, source_report: DataFrame, fetched: DataFrame,
                selected: DataFrame, checked: DataFrame, profile: Profile) -> DataFrame:
    """The nine build totals as ``(stat, value)`` rows: one aggregate pass
    per input, unpivoted with ``stack``."""
    lvl = _lvl()

    def long(df: DataFrame, **aggs) -> DataFrame:
        row = df.agg(*[c.cast("long").alias(n) for n, c in aggs.items()])
        pairs = ", ".join(f"'{n}', {n}" for n in aggs)
        return row.selectExpr(f"stack({len(aggs)}, {pairs}) as (stat, value)")

    parts = [
        long(sources, sources_total=F.count(F.lit(1))),
        long(source_report, sources_ok=F.count_if(F.col("ok")), sources_failed=F.count_if(~F.col("ok"))),
        long(fetched, entries_fetched_raw=F.count(F.lit(1))),
        long(selected, entries_after_dedupe=F.count(F.lit(1)),
             total_fallback_urls=F.coalesce(F.sum(F.size("fallback_urls")), F.lit(0))),
        long(checked, entries_strict=F.count_if(lvl >= profile.strict_min_level),
             entries_relaxed=F.count_if(lvl >= profile.relaxed_min_level),
             entries_dead=F.count_if(lvl < profile.relaxed_min_level)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def source_report(sources: DataFrame, parsed: DataFrame, fetched: DataFrame) -> DataFrame:
    """Per enabled source: whether its playlist was fetched (an empty one
    was), entry count (before the content filter), time and error, sorted by
    source name.  ``fetched``: (source_name, error, elapsed_ms)."""
    counts = parsed.groupBy("source_name").agg(F.count(F.lit(1)).alias("entries"))
    enabled = sources.where(F.coalesce(F.col("enabled"), F.lit(True)))
    tried = fetched.select(F.col("source_name").alias("tried"), F.col("error").alias("failure"), "elapsed_ms")
    j = enabled.join(tried, F.col("name") == F.col("tried"), "left").join(
        counts, F.col("name") == F.col("source_name"), "left")
    error = F.when(F.col("tried").isNull(), F.lit("not_fetched")).otherwise(F.coalesce("failure", F.lit("")))
    ok = error == ""
    return j.select(
        F.col("name").alias("source"), "url", ok.alias("ok"),
        F.when(ok, F.coalesce(F.col("entries"), F.lit(0))).otherwise(F.lit(0)).cast("long").alias("count"),
        "elapsed_ms", error.alias("error"),
    ).orderBy("source")


def audit_totals(checked: DataFrame, profile: Profile) -> DataFrame:
    """relaxed_total, strict_total, az_channels_total, other_country_total
    (one row) of the group audit."""
    lvl = _lvl()
    relaxed = lvl >= profile.relaxed_min_level
    return checked.agg(
        F.count_if(relaxed).alias("relaxed_total"),
        F.count_if(lvl >= profile.strict_min_level).alias("strict_total"),
        F.count_if(relaxed & (F.col("country") == "az")).alias("az_channels_total"),
        F.count_if(relaxed & (F.col("country") == "other")).alias("other_country_total"),
    )


def stamped(report: DataFrame) -> DataFrame:
    """A report with the time it was made (UTC, ISO 8601)."""
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    return report.withColumn("generated_at_utc", now)


def enabled_sources(sources: DataFrame) -> DataFrame:
    """Registry rows that are fetched: enabled, with a name and a URL."""
    return sources.where(F.coalesce(F.col("enabled"), F.lit(True))
                         & (F.coalesce(F.col("name"), F.lit("")) != "")
                         & (F.coalesce(F.col("url"), F.lit("")) != ""))
