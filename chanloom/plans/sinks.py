"""Writers for playlists, the published catalogue and reports.

A playlist is an ordered text file.  It is written as ordered part files:
rows are range-partitioned on their position and sorted inside each
partition, and the header is the row at position 0.  Concatenating the part
files in name order gives the playlist; no single task or the driver holds
a whole playlist.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Profile
from ..functions.text import title_case
from ..operators import dedupe as D
from ..operators import render as R
from ..operators import reports as RP
from ..operators import search_index as SI
from ..operators import tiers as T
from ..session import materialize


def _write_ordered(lines: DataFrame, path: str, by: str | None = None) -> None:
    """``lines``: (pos, value[, by]); writes text parts in ``pos`` order, as
    many as the session's shuffle settings give."""
    keys = ([by] if by else []) + ["pos"]
    df = lines.repartitionByRange(*keys).sortWithinPartitions(*keys)
    w = df.select(*(([by] if by else []) + ["value"])).write.mode("overwrite")
    if by:
        w = w.partitionBy(by)
    w.text(path)


def _title_column(titles: Mapping[str, str], key: str) -> Column:
    return T.title_lookup(titles, F.col(key), title_case(F.col(key)))


def write_playlists(ranked: DataFrame, out_dir: str, profile: Profile, playlist_title: str) -> None:
    """all.m3u (and the same as by-category-all.m3u), per-country and per-category
    playlists, and by-country/all.m3u.  ``ranked`` has ``rank`` and the
    entry columns (attrs, name, url, group_title, country, categories)."""
    spark = ranked.sparkSession
    country_titles, category_titles = profile.country_titles(), profile.category_titles()

    def with_header(rows: DataFrame, header: str) -> DataFrame:
        head = spark.createDataFrame([(0, header)], "pos long, value string")
        return head.unionByName(rows)

    # all.m3u: entries in rank order with their assigned group title.
    body = R.render_rows(ranked).select(F.col("rank").alias("pos"),
                                        F.concat_ws("\n", "extinf", "url").alias("value"))
    all_lines = materialize(with_header(body, R.header(playlist_title)))  # written twice
    _write_ordered(all_lines, f"{out_dir}/all.m3u.parts")
    _write_ordered(all_lines, f"{out_dir}/by-category-all.m3u.parts")

    # by-country/<country>: group title = country title.
    ctitle = _title_column(country_titles, "country")
    per_country = R.render_rows(ranked.withColumn("_t", ctitle), F.col("_t")).select(
        "country", F.col("rank").alias("pos"), F.concat_ws("\n", "extinf", "url").alias("value"))
    heads = ranked.select("country").distinct().select(
        "country", F.lit(0).cast("long").alias("pos"),
        F.concat(F.lit(f'#EXTM3U x-tvg-url="" x-playlist-name="{playlist_title} - '), ctitle,
                 F.lit('"')).alias("value"))
    _write_ordered(heads.unionByName(per_country), f"{out_dir}/by-country", by="country")

    # by-country/all.m3u: country ascending, rank order inside.
    by_country = R.render_country_rows(ranked, country_titles)
    bc = T.with_rank(by_country, [F.col("country")] + T.rank_order(), "pos").select(
        "pos", F.concat_ws("\n", "extinf", "url").alias("value"))
    _write_ordered(with_header(bc, R.header(f"{playlist_title} - All Countries")),
                   f"{out_dir}/by-country-all.m3u.parts")

    # by-category/<category>: one entry per category (empty -> general).
    cats = F.when(F.size("categories") > 0, F.col("categories")).otherwise(F.array(F.lit("general")))
    ex = ranked.withColumn("category", F.explode(cats))
    cat_title = _title_column(category_titles, "category")
    per_cat = R.render_rows(ex.withColumn("_t", cat_title), F.col("_t")).select(
        "category", F.col("rank").alias("pos"), F.concat_ws("\n", "extinf", "url").alias("value"))
    cheads = ex.select("category").distinct().select(
        "category", F.lit(0).cast("long").alias("pos"),
        F.concat(F.lit(f'#EXTM3U x-tvg-url="" x-playlist-name="{playlist_title} - '), cat_title,
                 F.lit('"')).alias("value"))
    _write_ordered(cheads.unionByName(per_cat), f"{out_dir}/by-category", by="category")


def write_catalogue(ranked: DataFrame, out_dir: str) -> None:
    """channels: Parquet partitioned by country and tier (filters on them
    prune partitions), trigram postings beside it, and JSON lines in rank
    order."""
    table = T.published(ranked, extra=("rank",))
    table.write.mode("overwrite").partitionBy("country", "tier").parquet(f"{out_dir}/channels.parquet")
    SI.write_postings(table, f"{out_dir}/channels.index")
    (table.repartitionByRange("rank").sortWithinPartitions("rank")
     .write.mode("overwrite").json(f"{out_dir}/channels.json"))


def write_reports(out_dir: str, checked: DataFrame, tiers: dict[str, DataFrame], profile: Profile,
                  stats: DataFrame | None = None, source_report: DataFrame | None = None) -> None:
    """verification, failed channels, group audit and build reports.
    Aggregates are small (one row per country / category / error); the
    failed-channel list is written distributed."""
    rdir = f"{out_dir}/reports"
    relaxed = T.assign_group_title(tiers["relaxed"], profile)
    RP.stamped(RP.verification_totals(checked, profile)).write.mode("overwrite").json(f"{rdir}/verification-totals")
    RP.failure_reasons(tiers["dead"]).coalesce(1).write.mode("overwrite").json(f"{rdir}/failure-reasons")
    order = D.output_order(tiers["dead"])
    failed = tiers["dead"].repartitionByRange(*order).sortWithinPartitions(*order)
    T.published(failed).write.mode("overwrite").json(f"{rdir}/failed-channels")
    RP.stamped(RP.audit_totals(checked, profile)).write.mode("overwrite").json(f"{rdir}/audit-totals")
    RP.country_counts(relaxed).coalesce(1).write.mode("overwrite").json(f"{rdir}/country-counts")
    RP.category_counts(relaxed).coalesce(1).write.mode("overwrite").json(f"{rdir}/category-counts")
    RP.country_list(relaxed.repartitionByRange(*T.rank_order()).sortWithinPartitions(*T.rank_order()), "az").write.mode("overwrite").json(f"{rdir}/az-channels")
    RP.other_examples(relaxed, 120).coalesce(1).write.mode("overwrite").json(f"{rdir}/other-examples")
    if stats is not None:
        stats.coalesce(1).write.mode("overwrite").json(f"{rdir}/build-stats")
    if source_report is not None:
        source_report.coalesce(1).write.mode("overwrite").json(f"{rdir}/source-report")
