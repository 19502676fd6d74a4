"""Entry scores.

Scores are exact DECIMAL(12,2) values (rounded half-up), not doubles: the
result is then identical in every engine.  ``score`` is exposed as DOUBLE
for readers; ``score_dec`` keeps the exact value for ordering.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import is_https
from .classify import attr

SCORE_TYPE = "decimal(12,2)"


def _d(value: float | int) -> Column:
    return F.lit(value).cast("decimal(12,3)")


def _flag(cond: Column, points: float) -> Column:
    return F.when(cond, _d(points)).otherwise(_d(0))


def pre_score_column(prefer_https: bool = True, of: Callable[[str], Column] = attr) -> Column:
    """weight, +10 https (if preferred), +5 tvg-id, +3 tvg-logo, +2 tvg-name;
    ``of`` gives an attribute's value."""
    # every entry is scored: whole points are added as integers, one decimal sum is left
    given = [(of("tvg-id") != "", 5), (of("tvg-logo") != "", 3), (of("tvg-name") != "", 2)]
    if prefer_https:
        given.append((is_https(F.col("url")), 10))
    points = reduce(lambda a, b: a + b, [F.when(cond, F.lit(n)).otherwise(F.lit(0)) for cond, n in given])
    return F.round(F.col("source_weight").cast("decimal(12,3)") + points.cast("decimal(12,3)"), 2).cast(SCORE_TYPE)


def post_score_column(prefer_https: bool = True) -> Column:
    """weight, +10 https, +30 alive / -25 dead, + max(0, 20 - latency s)
    (NULL or 0 latency counts as 20 s), +5 per level, +5 tvg-id, +3 tvg-logo."""
    score = F.col("source_weight").cast("decimal(12,3)")
    if prefer_https:
        score = score + _flag(is_https(F.col("url")), 10)
    alive = F.col("alive")
    score = score + F.when(alive.isNull(), _d(0)).when(alive, _d(30)).otherwise(_d(-25))
    latency = F.coalesce(F.when(F.col("latency_ms") != 0, F.col("latency_ms")), F.lit(20_000))
    bonus = _d(20) - latency.cast("decimal(12,3)") / F.lit(1000).cast("decimal(12,3)")
    score = score + F.greatest(bonus.cast("decimal(16,3)"), _d(0).cast("decimal(16,3)"))
    score = score + F.coalesce(F.col("check_level"), F.lit(0)).cast("decimal(12,3)") * _d(5)
    score = score + _flag(attr("tvg-id") != "", 5) + _flag(attr("tvg-logo") != "", 3)
    return F.round(score, 2).cast(SCORE_TYPE)


def pre_score(df: DataFrame, prefer_https: bool = True) -> DataFrame:
    s = pre_score_column(prefer_https)
    return df.withColumns({"score_dec": s, "score": s.cast("double")})


def post_score(df: DataFrame, prefer_https: bool = True) -> DataFrame:
    s = post_score_column(prefer_https)
    return df.withColumns({"score_dec": s, "score": s.cast("double")})
