"""De-duplication with ranked fallback URLs.

Two shuffles, each bounded against hot keys:

* by ``url``: keep the best-scored copy of every URL.  ``row_number() = 1``
  plans as a partial ``WindowGroupLimit`` before the exchange, so a URL that
  appears in a third of all rows still ships one row per map task.
* by ``dedupe_key``: rank the survivors of a channel name, keep
  ``keep + max_fallbacks`` of them (again limited before the exchange) and
  attach the fallback list with a second window over the same partitioning
  (no extra shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import first_normal, has_plain_word, normalize_text
from .classify import attr


def dedupe_key_column(norm_tvg_name: Column | None = None) -> Column:
    """Normalised name, else normalised tvg-name, else normalised URL."""
    if norm_tvg_name is None:
        norm_tvg_name = normalize_text(attr("tvg-name"))
    by_name = F.coalesce(F.nullif(F.col("norm_name"), F.lit("")), F.nullif(norm_tvg_name, F.lit("")))
    # the URL is only normalised for entries without a usable name
    return F.coalesce(by_name, normalize_text(F.when(by_name.isNull(), F.col("url"))))


def with_dedupe_key(df: DataFrame) -> DataFrame:
    if "norm_name" not in df.columns:
        tvg_name = F.col("tvg_name") if "tvg_name" in df.columns else attr("tvg-name")
        # from the raw texts at once; ``norm_name`` costs nothing where it is not read
        return df.withColumns({"norm_name": normalize_text(F.col("name")),
                               "dedupe_key": first_normal(F.col("name"), tvg_name, F.col("url"))})
    tvg = F.col("norm_tvg_name") if "norm_tvg_name" in df.columns else None
    return df.withColumn("dedupe_key", dedupe_key_column(tvg))


def dedupe_url(df: DataFrame) -> DataFrame:
    """One entry per URL: highest score; ties go to the first source / line."""
    # the hash only leads the sort: URLs share their first characters
    w = Window.partitionBy(F.xxhash64("url"), "url").orderBy(F.col("score_dec").desc(), "source_name", "entry_id")
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def best_of_name(df: DataFrame, keep_per_channel: int = 1, max_fallback_urls: int = 4) -> DataFrame:
    """The URL-unique entries that ``dedupe_channels`` can keep, before names
    are normalised: equal names have equal keys, so an entry behind as many of
    its own name as a channel keeps is behind them in its channel as well.
    Entries whose name may be blank once normalised are all left in."""
    # a plain name with a letter or digit is its own key, whatever the other
    # columns hold (a wide one may be a letter that normalises to nothing)
    blank = F.when(has_plain_word(F.col("name")), F.lit(None)).otherwise(F.col("url"))
    w = Window.partitionBy(F.xxhash64("name", blank), "name", blank).orderBy(F.col("score_dec").desc(), F.col("url"))
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= max(1, keep_per_channel) + max_fallback_urls).drop("_rn"))


def dedupe_channels(df: DataFrame, keep_per_channel: int = 1, max_fallback_urls: int = 4) -> DataFrame:
    """Winners per channel with their fallback URL lists.

    Input: URL-unique entries (``dedupe_url``) with ``score_dec``.
    Output: the winners (``keep`` per key, best score then URL) with
    ``fallback_urls`` (the next ``max_fallback_urls`` URLs in rank order,
    shared by all winners of a key), ``dedupe_key``, ``channel_rank`` and
    ``primary_url``.
    """
    if max_fallback_urls < 0:
        raise ValueError("max_fallback_urls must not be negative")
    keep = max(1, keep_per_channel)
    if "dedupe_key" not in df.columns:
        df = with_dedupe_key(df)
    key = [F.xxhash64("dedupe_key"), F.col("dedupe_key")]
    w = Window.partitionBy(*key).orderBy(F.col("score_dec").desc(), F.col("url"))
    ranked = (df.withColumn("channel_rank", F.row_number().over(w))
              .where(F.col("channel_rank") <= keep + max_fallback_urls))
    group = Window.partitionBy(*key)
    alternates = F.collect_list(
        F.when(F.col("channel_rank") > keep, F.struct("channel_rank", "url"))).over(group)
    with_fb = ranked.withColumn(
        "fallback_urls", F.transform(F.array_sort(alternates), lambda x: x["url"]))
    return (with_fb.where(F.col("channel_rank") <= keep)
            .withColumn("primary_url", F.col("url")))


def output_order(df: DataFrame) -> list[Column]:
    """Order of the selection: country, lower-case name, URL."""
    return [F.col("country"), F.lower("name"), F.col("url")]
