"""Catalogue search over the published table (the portal's filter query).

All filters are optional and AND-ed: a lower-case substring of
``name + ' ' + group_title + ' ' + source_name``, country equality,
category membership and tier equality.  On a published table partitioned
by country, the country predicate prunes partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def haystack() -> Column:
    """What a text is searched in."""
    return F.lower(F.concat_ws(" ", F.coalesce(F.col("name"), F.lit("")),
                               F.coalesce(F.col("group_title"), F.lit("")),
                               F.coalesce(F.col("source_name"), F.lit(""))))


def search_predicate(text: str | None = None, country: str | None = None,
                     category: str | None = None, tier: str | None = None) -> Column:
    cond = F.lit(True)
    q = (text or "").strip().lower()
    if q:
        cond = cond & haystack().contains(q)
    if country:
        cond = cond & (F.col("country") == country)
    if category:
        cond = cond & F.coalesce(F.array_contains(F.col("categories"), category), F.lit(False))
    if tier:
        cond = cond & (F.col("tier") == tier)
    return cond


def catalogue_search(channels: DataFrame, text: str | None = None, country: str | None = None,
                     category: str | None = None, tier: str | None = None) -> DataFrame:
    return channels.where(search_predicate(text, country, category, tier))


def search_stats(channels: DataFrame, text: str | None = None, country: str | None = None,
                 category: str | None = None, tier: str | None = None) -> DataFrame:
    """shown / total / strict / relaxed counts of a search, in one pass."""
    hit = search_predicate(text, country, category, tier)
    return channels.agg(
        F.count_if(hit).alias("shown"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(hit & (F.col("tier") == "strict")).alias("strict"),
        F.count_if(hit & (F.col("tier") == "relaxed")).alias("relaxed"),
    )


def facet_countries(channels: DataFrame) -> DataFrame:
    return (channels.select("country").where(F.coalesce(F.col("country"), F.lit("")) != "")
            .distinct().orderBy("country"))


def facet_categories(channels: DataFrame) -> DataFrame:
    return (channels.select(F.explode(F.coalesce(F.col("categories"), F.array())).alias("category"))
            .where(F.coalesce(F.col("category"), F.lit("")) != "").distinct().orderBy("category"))
