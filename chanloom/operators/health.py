"""Probe reports, fallback candidates, URL swap and report application.

Probe attempts are data (captured results, one row per URL and attempt),
so the "health check" is relational: rank attempts per URL, join the report
to entries by URL, explode fallback lists of dead entries and pick the first
live one.  Every step is keyed by URL or by the entry's primary URL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

REPORT_SCHEMA = ("url string, check_level int, alive boolean, status_code int, "
                 "latency_ms int, error string")


def best_attempt(attempts: DataFrame, retries: int = 2, keep_error: bool = False) -> DataFrame:
    """Report per URL from its attempts (``url, attempt, check_level,
    status_code, latency_ms, error``).

    Attempts run in order and stop at the first level >= 2, so the result is
    the first attempt with level >= 2, else the first with level 1, else the
    constant (0, NULL, NULL, 'unknown') - the error of a dead URL is not
    kept (``keep_error=True`` keeps the first attempt's error instead).
    Only the first ``max(1, retries)`` attempts count.
    """
    n = max(1, retries)
    lvl = F.coalesce(F.col("check_level"), F.lit(0))
    a = attempts.where(F.col("attempt") <= n)
    prio = F.when(lvl >= 2, 0).when(lvl == 1, 1).otherwise(2)
    # the hash only leads the sort: URLs share their first characters
    w = Window.partitionBy(F.xxhash64("url"), "url").orderBy(prio, F.col("attempt"))
    top = a.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    live = lvl >= 1
    dead_error = F.coalesce(F.col("error"), F.lit("")) if keep_error else F.lit("unknown")
    return top.select(
        "url",
        F.when(live, lvl).otherwise(F.lit(0)).cast("int").alias("check_level"),
        live.alias("alive"),
        F.when(live, F.col("status_code")).cast("int").alias("status_code"),
        F.when(live, F.col("latency_ms")).cast("int").alias("latency_ms"),
        F.when(live, F.coalesce(F.col("error"), F.lit(""))).otherwise(dead_error).alias("error"),
    )


def probe_targets(entries: DataFrame) -> DataFrame:
    """Distinct URLs to probe."""
    return entries.select("url").distinct()


def probe_report(attempts: DataFrame, targets: DataFrame, retries: int = 2,
                 keep_error: bool = False) -> DataFrame:
    """``best_attempt`` restricted to the target URLs (semi-join first, so
    only needed attempts reach the ranking)."""
    needed = attempts.join(targets.select("url").distinct(), "url", "left_semi")
    return best_attempt(needed, retries, keep_error)


def fallback_candidates(selected: DataFrame, primary_report: DataFrame, max_fallbacks: int = 3) -> DataFrame:
    """Fallback URLs to probe: the first ``max_fallbacks`` of every entry
    whose primary level is below 1, minus URLs already known."""
    if max_fallbacks < 0:
        raise ValueError("max_fallbacks must not be negative")
    rep = primary_report.select(F.col("url").alias("_u"), F.col("check_level").alias("_lvl"))
    dead = (selected.join(rep, selected.url == rep._u, "left")
            .where(F.coalesce(F.col("_lvl"), F.lit(0)) < 1))
    fb = dead.select(F.explode(F.slice("fallback_urls", 1, max_fallbacks)).alias("url"))
    known = selected.select("url").unionByName(primary_report.select("url"))
    return fb.join(known, "url", "left_anti").distinct()


def fallback_swap(selected: DataFrame, report: DataFrame, max_fallbacks: int = 3) -> DataFrame:
    """Replace the URL of a dead entry by its first fallback (in list order)
    whose level is above the primary's; other fields stay unchanged."""
    if max_fallbacks < 0:
        raise ValueError("max_fallbacks must not be negative")
    rep = report.select(F.col("url").alias("_u"), F.col("check_level").alias("_lvl"))
    base = selected.join(rep, selected.url == rep._u, "left").drop("_u")
    primary_level = F.coalesce(F.col("_lvl"), F.lit(0))
    dead = base.where(primary_level < 1).select(
        "primary_url", primary_level.alias("_plvl"),
        F.posexplode(F.slice("fallback_urls", 1, max_fallbacks)).alias("_pos", "_fb"))
    live = (dead.join(rep, dead._fb == rep._u)
            .where(F.col("_lvl") > F.col("_plvl"))
            .groupBy("primary_url")
            .agg(F.min_by("_fb", "_pos").alias("_new_url")))
    return (base.drop("_lvl").join(live, "primary_url", "left")
            .withColumn("url", F.coalesce(F.col("_new_url"), F.col("url")))
            .drop("_new_url"))


def apply_health(entries: DataFrame, report: DataFrame) -> DataFrame:
    """Copy the report of each entry's current URL; URLs without a report are
    dead with error ``not_checked``."""
    rep = report.select(F.col("url").alias("_u"), F.col("check_level").alias("_lvl"),
                        F.col("alive").alias("_alive"), F.col("status_code").alias("_st"),
                        F.col("latency_ms").alias("_lat"), F.col("error").alias("_err"))
    j = entries.join(rep, entries.url == rep._u, "left")
    found = F.col("_u").isNotNull()
    return j.withColumns({
        "alive": F.when(found, F.col("_alive")).otherwise(F.lit(False)),
        "status_code": F.when(found, F.col("_st")).cast("int"),
        "latency_ms": F.when(found, F.col("_lat")).cast("int"),
        "check_error": F.when(found, F.coalesce(F.col("_err"), F.lit(""))).otherwise(F.lit("not_checked")),
        "check_level": F.when(found, F.coalesce(F.col("_lvl"), F.lit(0))).otherwise(F.lit(0)).cast("int"),
    }).drop("_u", "_lvl", "_alive", "_st", "_lat", "_err")


def settle(selected: DataFrame, report: DataFrame, max_fallbacks: int = 3) -> DataFrame:
    """``fallback_swap`` and ``apply_health`` in one pass: every entry's URL
    and the fallbacks that may be tried are exploded together, the report is
    joined once, and each entry takes its own row or, when that is dead, its
    first live fallback's."""
    if max_fallbacks < 0:
        raise ValueError("max_fallbacks must not be negative")
    urls = F.concat(F.array("url"), F.slice("fallback_urls", 1, max_fallbacks))
    tries = selected.select("primary_url", F.struct(*selected.columns).alias("_row"), F.posexplode(urls).alias("_pos", "_url"))
    # only the entry's own try carries its columns
    tries = tries.withColumn("_row", F.when(F.col("_pos") == 0, F.col("_row")))
    facts = F.struct("check_level", "alive", "status_code", "latency_ms", "error")
    found = report.select(F.col("url").alias("_u"), facts.alias("_rep"))
    j = tries.join(found, F.col("_url") == F.col("_u"), "left")
    level = F.coalesce(F.col("_rep.check_level"), F.lit(0))
    one_try = F.struct("_url", "_rep")
    per = j.groupBy("primary_url").agg(
        F.first("_row", ignorenulls=True).alias("_row"),
        F.first(F.when(F.col("_pos") == 0, one_try), ignorenulls=True).alias("_own"),
        F.min_by(one_try, F.when((F.col("_pos") > 0) & (level >= 1), F.col("_pos"))).alias("_live"))
    dead = F.coalesce(F.col("_own._rep.check_level"), F.lit(0)) < 1
    per = per.withColumn("_use", F.when(dead & F.col("_live").isNotNull(), F.col("_live")).otherwise(F.col("_own")))
    known = F.col("_use._rep").isNotNull()
    rest = [F.col(f"_row.{c}").alias(c) for c in selected.columns if c != "url"]
    return per.select(
        *rest, F.col("_use._url").alias("url"),
        F.coalesce(F.col("_use._rep.alive"), F.lit(False)).alias("alive"),
        F.col("_use._rep.status_code").cast("int").alias("status_code"),
        F.col("_use._rep.latency_ms").cast("int").alias("latency_ms"),
        F.when(known, F.coalesce(F.col("_use._rep.error"), F.lit(""))).otherwise(F.lit("not_checked")).alias("check_error"),
        F.coalesce(F.col("_use._rep.check_level"), F.lit(0)).cast("int").alias("check_level"))
