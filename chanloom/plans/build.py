"""Stage composition of a catalogue build.

Each stage is a ``DataFrame -> DataFrame`` function; this module only wires
them in the order of the original tool:

    entries -> classify -> overrides -> content filter -> pre-score
            -> dedupe by URL -> dedupe by channel (+ fallbacks)
            -> probe report -> fallback swap -> apply report -> post-score
            -> tiers -> outputs / reports
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Profile
from ..operators import classify as C
from ..operators import dedupe as D
from ..operators import health as H
from ..operators import score as S
from ..operators import tiers as T
from ..functions.text import normalize_text
from ..operators.classify import attr
from ..session import materialize


#: Columns that the filter, the score and the choice of channels read, with
#: the source and the attributes.
DECIDING = ("entry_id", "name", "url", "group_title")
#: Winners that are joined by broadcast.
BROADCAST_ROWS = 100_000


def is_small(winners: DataFrame) -> bool:
    """Whether the (written) winners may be broadcast."""
    return winners.count() <= BROADCAST_ROWS


def prepared_entries(entries: DataFrame, profile: Profile, by_name: DataFrame | None = None,
                     by_url: DataFrame | None = None) -> DataFrame:
    """Classified, overridden, filtered and pre-scored entries."""
    df = C.classify(entries, profile)
    if by_name is not None or by_url is not None:
        df = C.apply_overrides(df, by_name, by_url)
    df = C.content_filter(df, profile.unwanted_keywords)
    return S.pre_score(df, profile.prefer_https)


def selected_channels(prepared: DataFrame, profile: Profile) -> DataFrame:
    unique = D.dedupe_url(prepared)
    keyed = D.with_dedupe_key(unique)
    return D.dedupe_channels(keyed, profile.keep, profile.max_fallback_urls)


def select_entries(entries: DataFrame, profile: Profile, by_name: DataFrame | None = None,
                   by_url: DataFrame | None = None) -> DataFrame:
    """``selected_channels`` of ``prepared_entries``: the same rows, with
    country and categories worked out for the entries that win their URL and
    name.  Neither the filter nor the score nor the ranks read them, unless
    overrides rename entries: then all are classified first.

    The filter keeps its normalised texts to itself, so that the planner can
    put it where the texts come from; the name is normalised again for the
    entries that win their URL."""
    if by_name is not None or by_url is not None:
        return selected_channels(prepared_entries(entries, profile, by_name, by_url), profile)
    df = entries.select("*", normalize_text(F.col("name")).alias("norm_name"), normalize_text(F.col("group_title")).alias("norm_group"))
    df = C.content_filter(df, profile.unwanted_keywords).drop("norm_name", "norm_group")
    chosen = selected_channels(S.pre_score(df, profile.prefer_https), profile)
    return C.classify(chosen.drop("norm_name"), profile)


def written_selection(entries: DataFrame, profile: Profile, fetch: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``select_entries``, written.  The channels are chosen on the columns
    that decide, so neither the attribute maps nor the tags of all entries are
    made, sorted and exchanged; the winners' whole rows are then fetched.
    ``fetch``: the entries of given ids (entry_id); others may be among them.

    Entries that agree in all those columns are the same to the choice: any
    one of them is fetched, as any one of them won."""
    df = entries.select("source_name", "source_weight", *DECIDING, *[attr(name).alias(name) for name in ("tvg-id", "tvg-logo", "tvg-name")],
                        normalize_text(F.col("name")).alias("norm_name"), normalize_text(F.col("group_title")).alias("norm_group"))
    df = C.content_filter(df, profile.unwanted_keywords)
    score = S.pre_score_column(profile.prefer_https, lambda name: F.col(f"`{name}`"))
    df = df.select("source_name", *DECIDING, F.col("tvg-name").alias("tvg_name"), score.alias("score_dec"))
    unique = D.best_of_name(D.dedupe_url(df), profile.keep, profile.max_fallback_urls)
    winners = materialize(D.dedupe_channels(D.with_dedupe_key(unique), profile.keep, profile.max_fallback_urls).drop("norm_name"))

    hint = F.broadcast if is_small(winners) else (lambda rows: rows)
    near = fetch(hint(winners.select("entry_id").distinct()))
    near = S.pre_score(near, profile.prefer_https).withColumn("tvg_name", attr("tvg-name"))
    deciding = ["source_name", *DECIDING, "tvg_name", "score_dec"]
    won = winners.select(*[F.col(c).alias(f"_{c}") for c in deciding], "dedupe_key", "channel_rank", "fallback_urls", "primary_url")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in deciding])
    rows = near.join(hint(won), same).drop("tvg_name", *[f"_{c}" for c in deciding])
    return materialize(C.classify(D.dedupe_url(rows), profile))


@dataclass
class Checked:
    """Everything after the health stage."""

    checked: DataFrame      # all selected entries with health fields and post-score
    report: DataFrame       # url -> check_level, alive, status_code, latency_ms, error
    candidates: DataFrame   # fallback URLs that were probed
    selected: DataFrame | None = None


def health_stage(selected: DataFrame, attempts: DataFrame | None, profile: Profile, small: bool = False) -> Checked:
    """Probe report for primaries, fallback probe for dead ones, swap, apply,
    post-score.  With the health check disabled every entry is level 1.
    ``small``: the selection may be broadcast, so that attempts of other URLs
    are left out where they are read."""
    if not profile.healthcheck_enabled or attempts is None:
        checked = selected.withColumns({
            "alive": F.lit(None).cast("boolean"), "status_code": F.lit(None).cast("int"),
            "latency_ms": F.lit(None).cast("int"), "check_error": F.lit(""),
            "check_level": F.lit(1)})
        empty = selected.sparkSession.createDataFrame([], H.REPORT_SCHEMA)
        return Checked(S.post_score(checked, profile.prefer_https), empty, empty.select("url"), selected)
    # A report row depends only on its URL, so primaries and every fallback
    # that may be tried are reported together; nothing is computed here yet.
    # Attempts of other URLs are left out before they are ranked.
    tried = F.concat(F.array("url"), F.slice("fallback_urls", 1, profile.max_fallbacks))
    targets = selected.select(F.explode(tried).alias("url"))
    report = H.probe_report(attempts, F.broadcast(targets) if small else targets, profile.retries, profile.keep_error)
    checked = H.settle(selected, report, profile.max_fallbacks)
    primaries = H.probe_report(attempts, selected, profile.retries, profile.keep_error)
    candidates = H.fallback_candidates(selected, primaries, profile.max_fallbacks)
    return Checked(S.post_score(checked, profile.prefer_https), report, candidates, selected)


def tiers(checked: DataFrame, profile: Profile) -> dict[str, DataFrame]:
    labelled = T.with_tier(checked)
    return {
        "strict": T.tier_filter(labelled, "strict", profile),
        "relaxed": T.tier_filter(labelled, "relaxed", profile),
        "dead": T.tier_filter(labelled, "dead", profile),
        "all": labelled,
    }
