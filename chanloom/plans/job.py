"""End-to-end catalogue build from native inputs.

    landing dir of playlists + sources.json + profile.json + overrides.json
    + captured http_samples  ->  playlists, channels, reports

Every stage is a DataFrame operator; the only driver-side data are the
configuration documents.  Stage boundaries that several writers read are
checkpointed into the session's checkpoint folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import PLAYLIST_TITLE, STRICT_PLAYLIST_TITLE, Profile
from ..operators import parse as P
from ..operators import probe as PR
from ..operators import reports as RP
from ..operators import tiers as T
from ..session import apply_required_conf, ensure_checkpoint_dir, materialize
from ..sources import manifest as MF
from ..sources import readers as RD
from . import build as B
from . import publish as PB
from . import sinks as K


@dataclass
class BuildResult:
    relaxed: DataFrame
    strict: DataFrame
    dead: DataFrame
    checked: DataFrame
    stats: DataFrame
    source_report: DataFrame


def build_catalogue(spark: SparkSession, lines: DataFrame, sources: DataFrame, samples: DataFrame | None,
                    profile: Profile, by_name: DataFrame | None = None, by_url: DataFrame | None = None,
                    chunk_lines: int = P.DEFAULT_CHUNK_LINES, fetch_log: DataFrame | None = None) -> BuildResult:
    """All stages from playlist lines to ranked tiers and build totals."""
    # The boundary after the parse: the report, the selection and the totals read it.
    parsed = materialize(P.m3u_parse(lines, chunk_lines))
    if fetch_log is None:
        fetch_log = lines.select("source_name").distinct().select(
            "source_name", F.lit("").alias("error"), F.lit(None).cast("int").alias("elapsed_ms"))
    report = RP.source_report(sources, parsed, fetch_log)
    entries = P.with_source_attributes(parsed, sources.where("enabled"))
    fetched = B.prepared_entries(entries, profile, by_name, by_url)
    selected = B.select_entries(entries, profile, by_name, by_url)
    attempts = None
    if samples is not None and profile.healthcheck_enabled:
        # only what may be probed: selected URLs and their fallbacks
        selected = materialize(selected)
        targets = selected.select("url").unionByName(selected.select(F.explode("fallback_urls").alias("url")))
        attempts = PR.probe_levels(samples, targets, deny_markers=profile.deny_markers)
    ck = B.health_stage(selected, attempts, profile)
    selected = ck.selected
    checked = materialize(ck.checked)
    tiers = B.tiers(checked, profile)
    relaxed = T.with_rank(T.assign_group_title(tiers["relaxed"], profile))
    strict = T.with_rank(T.assign_group_title(tiers["strict"], profile))
    stats = RP.build_stats(sources, report, fetched, selected, checked, profile)
    return BuildResult(relaxed, strict, tiers["dead"], checked, stats, report)


def run_build(spark: SparkSession, landing_dir: str, sources_path: str, profile_path: str | None,
              overrides_path: str | None, samples_path: str | None, output_dir: str,
              profile: Profile | None = None, fetch_log_path: str | None = None, manifest_dir: str | None = None) -> BuildResult:
    """``manifest_dir``: where the log of landed files is kept from build to
    build; without one the landing folder is listed whole."""
    apply_required_conf(spark)
    ensure_checkpoint_dir(spark)
    profile = profile or (RD.read_profile(spark, profile_path) if profile_path else Profile())
    sources = RD.read_sources(spark, sources_path)
    files = MF.refresh(spark, manifest_dir, landing_dir) if manifest_dir else None
    lines = RD.playlist_lines(spark, landing_dir, sources, files=files)
    by_name = by_url = None
    if overrides_path:
        by_name, by_url = RD.read_overrides(spark, overrides_path)
    samples = RD.read_samples(spark, samples_path) if samples_path else None
    fetch_log = RD.fetch_results(spark, landing_dir, fetch_log_path, files=files)
    res = build_catalogue(spark, lines, sources, samples, profile, by_name, by_url, fetch_log=fetch_log)
    # a version of its own: what is live stays whole until all is written
    folder = PB.begin(spark, output_dir)
    K.write_playlists(res.relaxed, folder, profile, PLAYLIST_TITLE)
    K.write_catalogue(res.relaxed, folder)
    K.write_playlists(res.strict, f"{folder}/strict", profile, STRICT_PLAYLIST_TITLE)
    K.write_catalogue(res.strict, f"{folder}/strict")
    K.write_reports(folder, res.checked, {"relaxed": res.relaxed, "strict": res.strict, "dead": res.dead},
                    profile, res.stats, res.source_report)
    PB.commit(spark, folder)
    return res
