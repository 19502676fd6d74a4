"""Registered queries: one per operator of the inventory.

Each query takes ``(spark, sf_dir)``, reads the whole driver tables through
the fixture relations and returns a DataFrame whose columns are aliased to
match the SQL oracle (``chanloom.plans.oracle``).  Arrays are rendered as
comma-joined text so both engines hash them the same way.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PLAYLIST_TITLE, Profile
from ..operators import classify as C
from ..operators import dedupe as D
from ..operators import health as H
from ..functions import payload as PL
from ..functions import text as TX
from ..functions import urls as U
from ..operators import parse as P
from ..operators import probe as PR
from ..operators import render as R
from ..operators import reports as RP
from ..operators import rule_tables as RT
from ..operators import search as SR
from ..operators import search_index as SI
from ..operators import score as S
from ..operators import tiers as T
from ..session import ensure_checkpoint_dir, materialize
from ..sources import fixtures as FX
from ..sources import published as PS
from ..sources import readers as RD
from . import build as B
from . import publish as PB
from . import sinks as K

PROFILE = FX.FIXTURE_PROFILE
# One attempt per URL and one fallback tried: leaves a non-empty dead tier.
PROFILE_R1 = PROFILE.with_(retries=1, max_fallbacks=1)

Query = Callable[[SparkSession, str], DataFrame]


def _join(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(c, ",")


def _classified(spark: SparkSession, d: str) -> DataFrame:
    return C.classify(FX.entries(spark, d), PROFILE)


def _prepared(spark: SparkSession, d: str) -> DataFrame:
    return B.prepared_entries(FX.entries(spark, d), PROFILE)


def _selected(spark: SparkSession, d: str, profile: Profile = PROFILE) -> DataFrame:
    return B.select_entries(FX.entries(spark, d), profile)


def _checked(spark: SparkSession, d: str, profile: Profile = PROFILE) -> B.Checked:
    # written: the report and the swap both read it
    selected = B.written_selection(FX.entries(spark, d), profile, lambda ids: FX.entries(spark, d, ids))
    return B.health_stage(selected, FX.url_attempts(spark, d), profile, B.is_small(selected))


def _tiers(spark: SparkSession, d: str, profile: Profile = PROFILE) -> dict[str, DataFrame]:
    return B.tiers(_checked(spark, d, profile).checked, profile)


# ---------------------------------------------------------------------------
# Entry pipeline: scoring, dedupe, rules
# ---------------------------------------------------------------------------

def q_pre_score(spark, d):
    df = S.pre_score(FX.entries(spark, d), PROFILE.prefer_https)
    return df.select("entry_id", "source_name", "url", "name", "score")


def q_dedupe_url(spark, d):
    df = D.dedupe_url(S.pre_score(FX.entries(spark, d), PROFILE.prefer_https))
    return df.select("url", "source_name", "entry_id", "source_weight", "score")


def q_dedupe_key(spark, d):
    df = D.with_dedupe_key(D.dedupe_url(S.pre_score(FX.entries(spark, d))))
    return df.select("url", "dedupe_key")


def q_dedupe_channels(spark, d):
    df = _selected(spark, d)
    return df.select("dedupe_key", "url", "source_name", "country", "score",
                     _join("fallback_urls").alias("fallback_urls"),
                     F.size("fallback_urls").alias("n_fallbacks"))


def q_fallback_list(spark, d):
    prof = PROFILE.with_(keep_per_channel=2, max_fallback_urls=3)
    df = _selected(spark, d, prof)
    return df.select("dedupe_key", "url", "channel_rank",
                     _join("fallback_urls").alias("fallback_urls"))


def q_classify_country(spark, d):
    return _classified(spark, d).select("entry_id", "source_name", "url", "country")


def q_classify_categories(spark, d):
    return _classified(spark, d).select("entry_id", "source_name", "url",
                                        _join("categories").alias("categories"))


def _overridden(spark, d, by_name: bool, by_url: bool):
    bn = FX.overrides_by_name(spark, d) if by_name else None
    bu = FX.overrides_by_url(spark, d) if by_url else None
    return C.apply_overrides(_classified(spark, d), bn, bu)


def q_override_by_name(spark, d):
    df = _overridden(spark, d, True, False)
    return df.select("entry_id", "source_name", "url", "name", "country",
                     _join("categories").alias("categories"))


def q_override_by_url(spark, d):
    df = _overridden(spark, d, True, True)
    return df.select("entry_id", "source_name", "url", "name", "country",
                     _join("categories").alias("categories"))


def q_override_documents(spark, d):
    by_name, by_url = C.override_tables(FX.override_documents(spark, d), keep=("p_partkey",))
    rows = by_name.withColumn("section", F.lit("by_name")).unionByName(by_url.withColumnRenamed("url", "key").withColumn("section", F.lit("by_url")))
    return rows.select("p_partkey", "section", "position", "key", "country", _join("categories").alias("categories"), "name", "is_object")


def q_source_registry(spark, d):
    rows = RD.registry_rows(FX.registry_documents(spark, d), keep=("s_suppkey",))
    return rows.select("s_suppkey", "name", "url", "enabled", "weight", _join("tags").alias("tags"))


def q_content_filter(spark, d):
    df = C.content_filter(_classified(spark, d), PROFILE.unwanted_keywords)
    return df.select("entry_id", "source_name", "url", "name", "group_title")


def _normalized(spark: SparkSession, d: str) -> DataFrame:
    return C.with_normalized(FX.entries(spark, d))


def q_classify_country_table(spark, d):
    df = RT.country_by_tables(_normalized(spark, d), FX.rule_tables(spark, d)["countries"])
    return df.select("entry_id", "source_name", "url", "country")


def q_classify_categories_table(spark, d):
    df = RT.categories_by_tables(_normalized(spark, d), FX.rule_tables(spark, d)["categories"])
    return df.select("entry_id", "source_name", "url", _join("categories").alias("categories"))


def q_content_filter_table(spark, d):
    df = RT.content_filter_by_table(_normalized(spark, d), FX.rule_tables(spark, d)["unwanted"])
    return df.select("entry_id", "source_name", "url", "name", "group_title")


def q_identity_keys(spark, d):
    df = _classified(spark, d)
    return df.select(
        "entry_id", "source_name", "url",
        F.concat_ws("::", "country", "norm_name").alias("dedup_key"),
        F.concat_ws("::", "norm_name", TX.py_strip(F.col("url"))).alias("stable_key"),
        F.col("norm_group").alias("normalized_group"))


def q_title_case(spark, d):
    e = FX.entries(spark, d)
    return e.select("entry_id", "source_name", "url",
                    TX.title_case(F.concat(F.lower("group_title"), F.lit("-"), F.col("name"), F.lit(" x"),
                                        F.col("attrs")["tvg-name"])).alias("title"))


def q_group_title(spark, d):
    df = T.assign_group_title(_selected(spark, d), PROFILE)
    return df.select("url", "country", _join("categories").alias("categories"), "group_title")


# ---------------------------------------------------------------------------
# Probe report, fallbacks, health, tiers
# ---------------------------------------------------------------------------

def q_best_attempt(spark, d):
    return H.best_attempt(FX.url_attempts(spark, d), PROFILE.retries)


def q_probe_targets(spark, d):
    return H.probe_targets(_selected(spark, d))


def q_fallback_candidates(spark, d):
    sel = _selected(spark, d)
    rep = H.probe_report(FX.url_attempts(spark, d), sel, PROFILE.retries)
    return H.fallback_candidates(sel, rep, PROFILE.max_fallbacks)


def q_fallback_swap(spark, d):
    ck = _checked(spark, d)
    return ck.checked.select("primary_url", "url", (F.col("url") != F.col("primary_url")).alias("swapped"))


def q_apply_health(spark, d):
    return _checked(spark, d).checked.select(
        "primary_url", "url", "alive", "status_code", "latency_ms", "check_error", "check_level")


def q_post_score(spark, d):
    return _checked(spark, d).checked.select("primary_url", "url", "check_level", "score")


def q_tier_label(spark, d):
    return T.with_tier(_checked(spark, d).checked).select("primary_url", "check_level", "tier")


def _tier_rows(df: DataFrame) -> DataFrame:
    return df.select("primary_url", "url", "country", "check_level", "score")


def q_tier_strict(spark, d):
    return _tier_rows(_tiers(spark, d)["strict"])


def q_tier_relaxed(spark, d):
    return _tier_rows(_tiers(spark, d)["relaxed"])


def q_tier_dead(spark, d):
    return _tier_rows(_tiers(spark, d, PROFILE_R1)["dead"])


def q_tier_ranked(spark, d):
    ranked = T.with_rank(_tiers(spark, d)["relaxed"])
    return ranked.select("rank", "primary_url", "url", "country", "name", "score")


def _published_relaxed(spark, d) -> DataFrame:
    relaxed = T.assign_group_title(_tiers(spark, d)["relaxed"], PROFILE)
    return T.published(relaxed)


def _flat(df: DataFrame) -> DataFrame:
    """Published rows with arrays as text."""
    return df.withColumns({"source_tags": _join("source_tags"), "categories": _join("categories")})


def q_publish_channels(spark, d):
    return _flat(_published_relaxed(spark, d))


def q_failed_channels(spark, d):
    return _flat(T.published(_tiers(spark, d, PROFILE_R1)["dead"]))


# ---------------------------------------------------------------------------
# Playlist lines and parsing
# ---------------------------------------------------------------------------

def attrs_text(m: Column) -> Column:
    """Attribute map as sorted ``key=value`` text joined by ';'."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(
        e["key"], F.lit("="), e["value"]))), ";")


def q_m3u_lines(spark, d):
    docs = FX.read_table(spark, d, "documents", ["doc_id", "text"])
    return P.text_lines(docs, "text", ("doc_id",))


def _extinf_lines(spark, d) -> DataFrame:
    lines = FX.playlist_lines(spark, d)
    return lines.where(F.col("line").startswith("#EXTINF:"))


def q_extinf_parse(spark, d):
    li = _extinf_lines(spark, d)
    line = F.col("line")
    valid = P.extinf_valid(line)
    return li.select("source_name", "line_no", valid.alias("valid"),
                     F.regexp_extract(line, P.EXTINF_RE, 1).alias("duration"),
                     P.extinf_name(line).alias("name"),
                     P.extinf_blob(line).alias("attr_blob"))


def q_extinf_attrs(spark, d):
    li = _extinf_lines(spark, d)
    m = P.extinf_attrs(P.extinf_blob(F.col("line")))
    return li.select("source_name", "line_no", attrs_text(m).alias("attrs"),
                     F.size(m).alias("n_attrs"))


def q_m3u_parse(spark, d):
    parsed = P.m3u_parse(FX.playlist_lines(spark, d))
    return parsed.select("source_name", "entry_id", "name", "url", "group_title",
                         attrs_text(F.col("attrs")).alias("attrs"))


# ---------------------------------------------------------------------------
# Captured samples, URLs, payloads, text
# ---------------------------------------------------------------------------

def q_is_playlist(spark, d):
    hs = FX.http_samples(spark, d)
    return hs.select("url", "attempt", PL.is_playlist(F.col("content_type"), F.col("body")).alias("is_playlist"))


def q_first_media_uri(spark, d):
    hs = FX.http_samples(spark, d)
    return hs.select("url", "attempt", PL.first_media_uri(TX.utf8_ignore(F.col("body"))).alias("media_uri"))


def q_url_resolve(spark, d):
    hs = FX.http_samples(spark, d)
    first = PL.first_media_uri(TX.utf8_ignore(F.col("body")))
    return (hs.select("url", "attempt", first.alias("media_uri")).where(F.col("media_uri") != "")
            .select("url", "attempt", "media_uri", U.url_resolve(F.col("url"), F.col("media_uri")).alias("resolved")))


def q_probe_levels(spark, d):
    targets = FX.entry_urls(spark, d).select("url").distinct()
    lv = PR.probe_levels(FX.http_samples(spark, d), targets)
    return lv.select("url", "attempt", "check_level", "status_code", "latency_ms", "error")


def _pages(spark, d) -> DataFrame:
    return FX.read_table(spark, d, "pages", ["page_id", "url", "html"])


def q_url_scheme(spark, d):
    pg = _pages(spark, d)
    return pg.select("page_id", U.url_scheme(F.col("url")).alias("scheme"),
                     U.is_http_url(F.col("url")).alias("is_http"))


def q_url_host(spark, d):
    pg = _pages(spark, d)
    return pg.select("page_id", U.url_host(F.col("url")).alias("host"))


def q_denied_payload(spark, d):
    pg = _pages(spark, d)
    body = F.encode(F.col("html"), "UTF-8")
    ctype = F.when(F.col("page_id") % 2 == 0, F.lit("text/html; charset=utf-8")).otherwise(F.lit("video/mp2t"))
    return pg.select("page_id", PL.denied_payload(ctype, body, FX.FIXTURE_DENY_MARKERS).alias("denied"))


def q_normalize_text(spark, d):
    docs = FX.read_table(spark, d, "documents", ["doc_id", "text"])
    return docs.select("doc_id", TX.normalize_text(F.col("text")).alias("norm"))


# ---------------------------------------------------------------------------
# Rendering, sinks, reports, search
# ---------------------------------------------------------------------------

def _relaxed_titled(spark, d, profile: Profile = PROFILE) -> DataFrame:
    return T.assign_group_title(_tiers(spark, d, profile)["relaxed"], profile)


def q_m3u_render(spark, d):
    df = R.render_rows(_relaxed_titled(spark, d))
    return df.select("primary_url", "extinf", "url")


def q_m3u_render_country(spark, d):
    df = R.render_country_rows(_relaxed_titled(spark, d), PROFILE.country_titles())
    return df.select("primary_url", "extinf", "url")


def q_by_country_order(spark, d):
    rel = _relaxed_titled(spark, d)
    keys = [F.col("country")] + T.rank_order()
    return T.with_rank(rel, keys, "position").select("position", "country", "primary_url")


def q_by_category_rows(spark, d):
    rel = _relaxed_titled(spark, d)
    cats = F.when(F.size("categories") > 0, F.col("categories")).otherwise(F.array(F.lit("general")))
    ex = rel.withColumn("category", F.explode(cats))
    title = T.title_lookup(PROFILE.category_titles(), F.col("category"), TX.title_case(F.col("category")))
    return R.render_rows(ex, title).select("category", "primary_url", "extinf")


def q_report_verification(spark, d):
    return RP.verification_totals(_checked(spark, d, PROFILE_R1).checked, PROFILE_R1)


def q_report_failure_reasons(spark, d):
    return RP.failure_reasons(_tiers(spark, d, PROFILE_R1)["dead"])


def q_report_country_counts(spark, d):
    return RP.country_counts(_tiers(spark, d)["relaxed"])


def q_report_category_counts(spark, d):
    return RP.category_counts(_tiers(spark, d)["relaxed"])


def q_audit_country_list(spark, d):
    return _flat(RP.country_list(_relaxed_titled(spark, d), "az"))


def q_audit_other_top(spark, d):
    return _flat(RP.other_examples(_relaxed_titled(spark, d), 120))


def _parsed_sources(spark, d) -> DataFrame:
    return P.m3u_parse(FX.landed_lines(spark, d))


def q_source_report(spark, d):
    return RP.source_report(FX.sources(spark, d), _parsed_sources(spark, d), FX.fetch_log(spark, d))


def q_source_attributes(spark, d):
    df = P.with_source_attributes(_parsed_sources(spark, d), FX.sources(spark, d).where("enabled"))
    return df.select("source_name", "entry_id", "url", "source_weight", _join("source_tags").alias("source_tags"))


def q_selection_order(spark, d):
    sel = _selected(spark, d)
    return T.with_rank(sel, D.output_order(sel), "position").select("position", "country", "url")


def q_audit_totals(spark, d):
    return RP.audit_totals(_checked(spark, d, PROFILE_R1).checked, PROFILE_R1)


def q_publish_ranked(spark, d):
    relaxed = T.assign_group_title(_tiers(spark, d)["relaxed"], PROFILE)
    return T.published(T.with_rank(relaxed), extra=("rank",)).select("rank", "name", "url", "group_title", "tier", "score")


def q_enabled_sources(spark, d):
    src = RP.enabled_sources(FX.sources(spark, d))
    return src.select("name", "url", "weight", _join("tags").alias("tags"))


def q_build_stats(spark, d):
    prof = PROFILE_R1
    srcs = FX.sources(spark, d)
    report = RP.source_report(srcs, _parsed_sources(spark, d), FX.fetch_log(spark, d))
    fetched = B.prepared_entries(FX.entries(spark, d), prof)
    ck = _checked(spark, d, prof)
    return RP.build_stats(srcs, report, fetched, ck.selected, ck.checked, prof)


def _channels(spark, d) -> DataFrame:
    """channels.json: the published relaxed tier."""
    return _published_relaxed(spark, d)


SEARCH = {"text": "Ring", "category": "parts", "tier": "strict"}


def q_catalogue_search(spark, d):
    return _flat(SR.catalogue_search(_channels(spark, d), **SEARCH))


def q_catalogue_search_stats(spark, d):
    return SR.search_stats(_channels(spark, d), **SEARCH)


def _folder(spark, name: str) -> str:
    """A fresh folder beside the session's checkpoints."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/chanloom/{name}-{uuid.uuid4().hex}"


def q_published_playlists(spark, d):
    """The relaxed tier's playlists, published as a version and read back."""
    out = _folder(spark, "playlists")
    folder = PB.begin(spark, out)
    K.write_playlists(T.with_rank(_relaxed_titled(spark, d)), folder, PROFILE, PLAYLIST_TITLE)
    PB.commit(spark, folder)
    return PS.read_playlists(spark, PB.current(spark, out))


def q_catalogue_search_indexed(spark, d):
    out = _folder(spark, "catalogue")
    folder = PB.begin(spark, out)
    K.write_catalogue(T.with_rank(_relaxed_titled(spark, d)), folder)
    PB.commit(spark, folder)
    return _flat(SI.catalogue_search(spark, PB.current(spark, out), **SEARCH).select(*T.PUBLISHED_COLUMNS))


def q_facet_countries(spark, d):
    return SR.facet_countries(_channels(spark, d))


def q_facet_categories(spark, d):
    return SR.facet_categories(_channels(spark, d))


QUERIES: dict[str, Query] = {
    "pre_score": q_pre_score,
    "dedupe_url": q_dedupe_url,
    "dedupe_key": q_dedupe_key,
    "dedupe_channels": q_dedupe_channels,
    "fallback_list": q_fallback_list,
    "classify_country": q_classify_country,
    "classify_categories": q_classify_categories,
    "override_by_name": q_override_by_name,
    "override_by_url": q_override_by_url,
    "override_documents": q_override_documents,
    "source_registry": q_source_registry,
    "content_filter": q_content_filter,
    "classify_country_table": q_classify_country_table,
    "classify_categories_table": q_classify_categories_table,
    "content_filter_table": q_content_filter_table,
    "identity_keys": q_identity_keys,
    "title_case": q_title_case,
    "group_title": q_group_title,
    "best_attempt": q_best_attempt,
    "probe_targets": q_probe_targets,
    "fallback_candidates": q_fallback_candidates,
    "fallback_swap": q_fallback_swap,
    "apply_health": q_apply_health,
    "post_score": q_post_score,
    "tier_label": q_tier_label,
    "tier_strict": q_tier_strict,
    "tier_relaxed": q_tier_relaxed,
    "tier_dead": q_tier_dead,
    "tier_ranked": q_tier_ranked,
    "publish_channels": q_publish_channels,
    "failed_channels": q_failed_channels,
    "m3u_lines": q_m3u_lines,
    "extinf_parse": q_extinf_parse,
    "extinf_attrs": q_extinf_attrs,
    "m3u_parse": q_m3u_parse,
    "is_playlist": q_is_playlist,
    "first_media_uri": q_first_media_uri,
    "url_resolve": q_url_resolve,
    "probe_levels": q_probe_levels,
    "url_scheme": q_url_scheme,
    "url_host": q_url_host,
    "denied_payload": q_denied_payload,
    "normalize_text": q_normalize_text,
    "m3u_render": q_m3u_render,
    "m3u_render_country": q_m3u_render_country,
    "by_country_order": q_by_country_order,
    "by_category_rows": q_by_category_rows,
    "report_verification": q_report_verification,
    "report_failure_reasons": q_report_failure_reasons,
    "report_country_counts": q_report_country_counts,
    "report_category_counts": q_report_category_counts,
    "audit_country_list": q_audit_country_list,
    "audit_other_top": q_audit_other_top,
    "audit_totals": q_audit_totals,
    "source_report": q_source_report,
    "source_attributes": q_source_attributes,
    "selection_order": q_selection_order,
    "publish_ranked": q_publish_ranked,
    "enabled_sources": q_enabled_sources,
    "build_stats": q_build_stats,
    "catalogue_search": q_catalogue_search,
    "catalogue_search_stats": q_catalogue_search_stats,
    "published_playlists": q_published_playlists,
    "catalogue_search_indexed": q_catalogue_search_indexed,
    "facet_countries": q_facet_countries,
    "facet_categories": q_facet_categories,
}
