"""Probe levels from captured HTTP samples.

A probe follows up to three hops - the entry URL, the first media URI of a
playlist (child), the first media URI of the child (segment) - and grades
the result 0..3.  Every sample ``(url, attempt, status, content_type, body,
error, elapsed_ms)`` is first reduced to narrow facts (flags, the first
media line and the URL it leads to), which are written: bodies are read once
and never shuffled, and a reference is resolved once a sample.
Hops are left joins of the facts on (resolved URL, attempt); a row without a
next hop gets a key of its own that matches nothing, so such rows spread
evenly instead of meeting under NULL.  A child that many entries share is
salted (``skew``): its rows are dealt over several tasks and its one fact is
replicated, whatever the adaptive planner's settings are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DENY_MARKERS
from ..functions.payload import body_text, denied_payload, first_media_uri, is_playlist
from ..functions.urls import is_http_url, url_resolve
from ..session import materialize
from .skew import TASK_ROWS, hot_keys, salted_left_join

# Outcome of one probe: (stage, level, status source, error), first match wins.
# Levels and error labels are fixed values.
#   status source: 'none', 'entry', 'child' (child or else entry),
#   'segment' (segment or else entry).
STAGES = [
    ("unsupported", 0, "none", "unsupported_scheme"),
    ("entry_failed", 0, "entry", None),
    ("entry_denied", 0, "entry", "entry:denied_payload"),
    ("entry_stream", 1, "entry", ""),
    ("entry_empty", 1, "entry", "empty_playlist_but_connects"),
    ("child_unsupported", 1, "entry", "child_unsupported_scheme"),
    ("child_failed", 1, "entry", None),
    ("child_denied", 1, "entry", "child:denied_payload"),
    ("child_stream", 3, "child", ""),
    ("child_empty", 2, "child", ""),
    ("segment_unsupported", 2, "child", "segment_unsupported_scheme"),
    ("segment_failed", 2, "child", None),
    ("segment_denied", 2, "child", "segment:denied_payload"),
    ("segment_ok", 3, "segment", ""),
]


def sample_facts(samples: DataFrame, deny_markers: Sequence[str] = DENY_MARKERS,
                 head_bytes: int | None = None) -> DataFrame:
    """(url, attempt, fact): what the grading needs to know of a sample."""
    ctype, body = F.col("content_type"), F.col("body")
    samples = samples.withColumn("_first", first_media_uri(body_text(body)))
    return samples.select("url", "attempt", F.struct(
        F.col("status"), F.coalesce("error", F.lit("")).alias("error"), F.col("elapsed_ms").alias("ms"),
        denied_payload(ctype, body, deny_markers, head_bytes).alias("denied"),
        denied_payload(F.lit(""), body, deny_markers, head_bytes).alias("denied_by_tag"),
        is_playlist(ctype, body, head_bytes).alias("playlist"),
        F.col("_first").alias("first"), url_resolve(F.col("url"), F.col("_first")).alias("next")).alias("fact"))


def _next(rows: DataFrame, facts: DataFrame, target: Column, name: str, task_rows: int, asked: DataFrame) -> DataFrame:
    """Left join of the facts of ``target`` (null: no next hop) as ``name``.
    ``asked``: (_key, attempt) of written rows that include the targets; hot
    keys are counted there."""
    nowhere = F.concat(F.lit("\x00"), F.xxhash64("url", "attempt").cast("string"))
    hop = facts.select(F.col("url").alias("_key"), "attempt", F.col("fact").alias(name))
    keyed = rows.withColumn("_key", F.coalesce(target, nowhere))
    keys = ["_key", "attempt"]
    hot = hot_keys(asked.where(F.col("_key").isNotNull()), keys, task_rows)
    return salted_left_join(keyed, hop, keys, [F.col("url")], task_rows, hot).drop("_key")


def _failed(fact: str) -> Column:
    status = F.col(f"{fact}.status")
    return status.isNull() | (status >= 400) | (F.col(f"{fact}.error") != "")


def _fail_text(fact: str, label: str) -> Column:
    detail = F.coalesce(F.nullif(F.col(f"{fact}.error"), F.lit("")), F.col(f"{fact}.status").cast("string"), F.lit("None"))
    return F.concat(F.lit(f"{label}:"), F.when(F.col(fact).isNull(), F.lit("not_captured")).otherwise(detail))


def _first_true(conditions: dict[str, Column]) -> Column:
    return F.coalesce(*[F.when(c, F.lit(name)) for name, c in conditions.items()])


def probe_levels(samples: DataFrame, targets: DataFrame | None = None,
                 deny_markers: Sequence[str] = DENY_MARKERS, head_bytes: int | None = None,
                 task_rows: int = TASK_ROWS) -> DataFrame:
    """One graded result per (target URL, attempt).

    Output: ``url, attempt, check_level, status_code, latency_ms, error``
    (``latency_ms`` = elapsed time of the hops actually taken).
    """
    facts = materialize(sample_facts(samples, deny_markers, head_bytes))
    e = facts.withColumnRenamed("fact", "e")
    if targets is not None:
        e = e.join(targets.select("url").distinct(), "url", "left_semi")
    e = e.withColumn("child_url", F.col("e.next")).withColumn("stage", _first_true({
        "unsupported": ~is_http_url(F.col("url")),
        "entry_failed": _failed("e"),
        "entry_denied": F.col("e.denied"),
        "entry_stream": ~F.col("e.playlist"),
        "entry_empty": F.col("e.first") == "",
        "child_unsupported": ~is_http_url(F.col("child_url")),
    }))
    c = _next(e, facts, F.when(F.col("stage").isNull(), F.col("child_url")), "c", task_rows,
              facts.select(F.col("fact.next").alias("_key"), "attempt"))
    # the child's facts were found by its URL, so its own reference is the segment's
    c = c.withColumn("seg_url", F.when(F.col("stage").isNull(), F.col("c.next")))
    c = c.withColumn("stage", F.coalesce("stage", _first_true({
        "child_failed": _failed("c"),
        "child_denied": F.col("c.denied"),
        "child_stream": ~F.col("c.playlist"),
        "child_empty": F.col("c.first") == "",
        "segment_unsupported": ~is_http_url(F.col("seg_url")),
    })))
    c = materialize(c)  # its keys are counted before they are joined
    seg = F.when(F.col("stage").isNull(), F.col("seg_url"))
    j = _next(c, facts, seg, "s", task_rows, c.select(seg.alias("_key"), "attempt"))
    j = j.withColumn("stage", F.coalesce("stage", _first_true({
        "segment_failed": _failed("s"),
        "segment_denied": F.col("s.denied_by_tag"),
    }), F.lit("segment_ok")))

    st = F.col("stage")
    level = status = error = None
    fail_text = {"entry_failed": _fail_text("e", "entry"), "child_failed": _fail_text("c", "child"),
                 "segment_failed": _fail_text("s", "segment")}
    src_status = {
        "none": F.lit(None).cast("int"),
        "entry": F.col("e.status"),
        "child": F.coalesce(F.nullif(F.col("c.status"), F.lit(0)), F.col("e.status")),
        "segment": F.coalesce(F.nullif(F.col("s.status"), F.lit(0)), F.col("e.status")),
    }
    for name, lvl, src, err in STAGES:
        err_col = fail_text[name] if err is None else F.lit(err)
        level = F.when(st == name, F.lit(lvl)) if level is None else level.when(st == name, F.lit(lvl))
        status = (F.when(st == name, src_status[src]) if status is None
                  else status.when(st == name, src_status[src]))
        error = F.when(st == name, err_col) if error is None else error.when(st == name, err_col)

    hops = (F.when(st == "unsupported", 0)
            .when(st.isin("entry_failed", "entry_denied", "entry_stream", "entry_empty",
                          "child_unsupported"), 1)
            .when(st.isin("child_failed", "child_denied", "child_stream", "child_empty",
                          "segment_unsupported"), 2)
            .otherwise(3))
    took = [F.when(hops > i, F.col(f"{h}.ms")) for i, h in enumerate("ecs")]
    known = F.coalesce(*took).isNotNull()
    latency = F.when(st == "unsupported", F.lit(0)).when(known, sum((F.coalesce(m, F.lit(0)) for m in took), F.lit(0)))
    return j.select("url", "attempt", level.cast("int").alias("check_level"), status.cast("int").alias("status_code"),
                    latency.cast("int").alias("latency_ms"), error.alias("error"))
