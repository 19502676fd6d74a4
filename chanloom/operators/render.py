"""Playlist rendering: one ``#EXTINF`` line and one URL line per entry.

Attributes are written sorted by key as ``key="value"``; the group title
is set from an override (per-playlist title) or else the entry's non-empty
group title; a blank ``tvg-name`` is replaced by the channel name.  Values
are not escaped (same as the original format writer).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import py_strip, title_case
from .tiers import title_lookup

HEADER_TEMPLATE = '#EXTM3U x-tvg-url="" x-playlist-name="{title}"'


def header(title: str) -> str:
    return HEADER_TEMPLATE.format(title=title)


def extinf_line(group_override: Column | None = None) -> Column:
    """``#EXTINF:-1 <attrs>,<name>`` for the row's ``attrs``, ``name`` and
    ``group_title``.  ``group_override`` (a column; NULL or '' = none)
    replaces the group title."""
    attrs = F.coalesce(F.col("attrs"), F.create_map().cast("map<string,string>"))
    name = F.coalesce(F.col("name"), F.lit(""))
    own_group = F.when(F.coalesce(F.col("group_title"), F.lit("")) != "", F.col("group_title"))
    if group_override is not None:
        group = F.coalesce(F.when(group_override != "", group_override), own_group)
    else:
        group = own_group
    tvg_blank = py_strip(F.coalesce(attrs["tvg-name"], F.lit(""))) == ""
    kept = F.filter(F.map_entries(attrs), lambda e: ~(
        ((e["key"] == "group-title") & group.isNotNull())
        | ((e["key"] == "tvg-name") & tvg_blank)
        | e["value"].isNull()))
    extra = F.filter(F.array(
        F.when(group.isNotNull(), F.struct(F.lit("group-title").alias("key"), group.alias("value"))),
        F.when(tvg_blank, F.struct(F.lit("tvg-name").alias("key"), name.alias("value")))),
        lambda x: x.isNotNull())
    pairs = F.array_sort(F.concat(kept, extra))
    blob = F.array_join(F.transform(pairs, lambda e: F.concat(e["key"], F.lit('="'), e["value"], F.lit('"'))), " ")
    return F.concat(F.lit("#EXTINF:-1 "), blob, F.lit(","), name)


def render_rows(df: DataFrame, group_override: Column | None = None) -> DataFrame:
    """Adds ``extinf`` (attribute line) next to ``url``."""
    return df.withColumn("extinf", extinf_line(group_override))


def country_group(country_titles: Mapping[str, str]) -> Column:
    """Group title of the country-grouped playlists: the country's title, or
    ``country.title()`` when it has none."""
    return title_lookup(country_titles, F.col("country"), title_case(F.col("country")))


def render_country_rows(df: DataFrame, country_titles: Mapping[str, str]) -> DataFrame:
    return df.withColumn("extinf", extinf_line(country_group(country_titles)))
