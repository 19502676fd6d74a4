"""Playlist (M3U) parsing as a distributed scan.

The playlist format is a small state machine: an ``#EXTINF`` line sets the
pending attributes, ``#EXTGRP`` sets a pending group, and the next URL line
emits an entry and clears both.  Equivalent relational form, per source in
line order:

* a URL line emits iff the previous EXTINF-or-URL line is a valid EXTINF;
* its pending group is the last ``#EXTGRP`` after the previous emission.

Both are "last X before this row" questions, i.e. running scans.  A window
partitioned by source would put a whole (possibly huge) source in one task,
so the scan runs in two levels: lines are cut into chunks (blocks of the file scan, or
``chunk_lines`` line numbers); windows run inside ``(source, chunk)``; the
state entering each chunk comes from a per-chunk summary (one row per
chunk) scanned in chunk order and joined back.  Both levels read the same
four columns of the same exchange, so lines are scanned and shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import PY_SPACE_CLASS, py_strip, split_lines

# Fixed patterns of the playlist format (written for Java regex: ``\p{Nd}``
# and the explicit space class match Python's Unicode ``\d`` and ``\s``).
EXTINF_RE = "^#EXTINF:(-?\\p{Nd}+)" + PY_SPACE_CLASS + "*(.*?),(.*)$"
# A line that is neither blank nor another comment.
KEPT_RE = "\\A" + PY_SPACE_CLASS + "*+(?:[^#" + PY_SPACE_CLASS[1:] + "|#EXTINF:|#EXTGRP:)"
ATTR_RE = '([A-Za-z0-9\\-_]+)="([^"]*)"'

DEFAULT_CHUNK_LINES = 1 << 20
#: Columns that tell chunks apart (hash, and source with chunk).
KEY = ["_hash", "_key"]

# ---------------------------------------------------------------------------
# Lines
# ---------------------------------------------------------------------------

def text_lines(df: DataFrame, text_col: str = "text", keys: tuple[str, ...] = ()) -> DataFrame:
    """``splitlines`` + ``strip`` + drop blanks; ``line_no`` is the 0-based
    position in the split (gaps where blank lines were)."""
    exploded = df.select(*keys, F.posexplode(split_lines(F.coalesce(F.col(text_col), F.lit(""))))
                         .alias("line_no", "raw"))
    return (exploded.select(*keys, F.col("line_no").cast("long").alias("line_no"),
                            py_strip(F.col("raw")).alias("line"))
            .where(F.col("line") != ""))


# ---------------------------------------------------------------------------
# EXTINF
# ---------------------------------------------------------------------------

def extinf_valid(line: Column) -> Column:
    return line.rlike(EXTINF_RE)


def extinf_name(line: Column) -> Column:
    return py_strip(F.regexp_extract(line, EXTINF_RE, 3))


def extinf_blob(line: Column) -> Column:
    return F.regexp_extract(line, EXTINF_RE, 2)


def extinf_attrs(blob: Column) -> Column:
    """``key="value"`` pairs as a map; values stripped; a repeated key keeps
    its last value; the reserved ``__name__`` key is dropped.

    With the session's ``mapKeyDedupPolicy=LAST_WIN`` (set by
    ``apply_required_conf``) the map is built directly; otherwise repeated
    keys are removed explicitly first.
    """
    keys = F.regexp_extract_all(blob, F.lit(ATTR_RE), 1)
    vals = F.transform(F.regexp_extract_all(blob, F.lit(ATTR_RE), 2), py_strip)
    if _last_win():
        m = F.map_from_arrays(keys, vals)
    else:
        pairs = F.arrays_zip(keys.alias("k"), vals.alias("v"))
        last = F.filter(pairs, lambda p, i: ~F.exists(
            F.slice(keys, i + 2, F.greatest(F.size(keys) - i - 1, F.lit(0))), lambda k: k == p["k"]))
        m = F.map_from_entries(F.transform(last, lambda p: F.struct(p["k"].alias("key"), p["v"].alias("value"))))
    return F.when(F.array_contains(keys, "__name__"),
                  F.map_filter(m, lambda k, v: k != "__name__")).otherwise(m)


def _last_win() -> bool:
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    try:
        return spark is not None and spark.conf.get("spark.sql.mapKeyDedupPolicy") == "LAST_WIN"
    except Exception:  # noqa: BLE001
        return False


# ---------------------------------------------------------------------------
# Parse
# ---------------------------------------------------------------------------

def _dealt_lines(lines: DataFrame, chunk_lines: int) -> DataFrame:
    """EXTINF, EXTGRP and URL lines, shuffled by (source, chunk).

    Explicit: an input already hash-partitioned by source alone would also
    satisfy the windows' clustering and keep a hot source in one task."""
    chunk = F.col("chunk") if "chunk" in lines.columns else F.floor(F.col("line_no") / F.lit(chunk_lines))
    dealt = lines.select("source_name", chunk.cast("long").alias("chunk"), "line_no", py_strip(F.col("line")).alias("line"), F.col("line").rlike(KEPT_RE).alias("_kept")).where("_kept").drop("_kept")
    # A key that is never null: no filter on it is pushed into one level only,
    # so both levels read one exchange.  The hash leads the sorts.
    return dealt.select(F.xxhash64("source_name", "chunk").alias("_hash"), F.struct("source_name", "chunk").alias("_key"), "line_no", "line").repartition(*KEY)


def _typed(dealt: DataFrame) -> DataFrame:
    """Kind (E, G or U) and state of every dealt line; the name and attributes
    of an EXTINF line are parsed where an entry takes them."""
    line = F.col("line")
    kind = F.when(line.startswith("#EXTINF:"), "E").when(line.startswith("#EXTGRP:"), "G").otherwise("U")
    t = dealt.withColumn("kind", kind)
    valid = (F.col("kind") == "E") & extinf_valid(line)
    eu = F.when(F.col("kind") != "G", F.struct(
        F.col("kind").alias("kind"), valid.alias("valid"),
        F.when(valid, line).alias("line")))
    gval = F.when(F.col("kind") == "G", py_strip(F.substring(line, 9, 1 << 30)))
    return t.select(*KEY, "line_no", "kind", "line", eu.alias("eu"), gval.alias("gval"))


def _carry(value: Column) -> Column:
    """Value of the nearest earlier chunk (same source) where it is set."""
    w = (Window.partitionBy("source_name").orderBy("chunk")
         .rowsBetween(Window.unboundedPreceding, -1))
    return F.last(value, ignorenulls=True).over(w)


def m3u_parse(lines: DataFrame, chunk_lines: int = DEFAULT_CHUNK_LINES) -> DataFrame:
    """Entries of playlist lines ``(source_name, line_no, line[, chunk])``.

    Output: ``source_name, entry_id, name, url, group_title, attrs``.
    ``entry_id`` is the line number of the URL line; lines with a ``chunk``
    (the start of their file block) are numbered inside it, and ``entry_id``
    is the block's start plus the line's place in it (a block has no more
    lines than bytes, so numbers grow through the file).

    Plan: lines are shuffled once by ``(source, chunk)``; running windows
    inside a chunk give the local state; a per-chunk summary (first / last
    EXTINF-or-URL line, last local emission, last EXTGRP) is scanned in
    chunk order to get the state entering each chunk; the summary is joined
    back.  Only the summary is ordered per source.
    """
    t = _typed(_dealt_lines(lines, chunk_lines))
    local = Window.partitionBy(*KEY).orderBy("line_no")
    before = local.rowsBetween(Window.unboundedPreceding, -1)
    g = F.when(F.col("kind") == "G", F.struct(F.col("line_no").alias("at"), F.col("gval").alias("v")))

    # Local state (previous EXTINF/URL line, last EXTGRP) inside the chunk.
    t = t.withColumns({
        "prev_eu": F.last("eu", ignorenulls=True).over(before),
        "last_g": F.last(g, ignorenulls=True).over(before),
    })
    emit_local = (F.col("kind") == "U") & F.coalesce(
        (F.col("prev_eu.kind") == "E") & F.col("prev_eu.valid"), F.lit(False))
    t = t.withColumn("emit_local", emit_local)
    if "chunk" in lines.columns:
        place = F.col("line_no") - F.min("line_no").over(Window.partitionBy(*KEY))
        t = t.withColumn("entry_id", F.col("_key.chunk") + place + (F.col("_key.chunk") > 0).cast("long"))
    else:
        t = t.withColumn("entry_id", F.col("line_no"))
    t = t.withColumn("last_emit_local",
                     F.last(F.when(F.col("emit_local"), F.col("line_no")), ignorenulls=True).over(before))

    # Per-chunk summary and the state entering each chunk.
    eu_line = F.when(F.col("eu").isNotNull(), F.col("line_no"))
    s = t.groupBy(*KEY).agg(
        F.max_by("eu", eu_line).alias("last_eu"),
        F.min_by(F.struct(F.col("line_no").alias("at"), F.col("kind").alias("kind")), eu_line).alias("first_eu"),
        F.max(F.when(F.col("emit_local"), F.col("line_no"))).alias("local_emit"),
        F.max_by(g, F.when(F.col("kind") == "G", F.col("line_no"))).alias("chunk_g"))
    s = s.select("*", "_key.source_name", "_key.chunk")
    s = s.withColumn("carry_eu", _carry(F.col("last_eu")))
    first_is_emit = ((F.col("first_eu.kind") == "U") & F.coalesce(
        (F.col("carry_eu.kind") == "E") & F.col("carry_eu.valid"), F.lit(False)))
    s = s.withColumn("first_emit", F.when(first_is_emit, F.col("first_eu.at")))
    chunk_emit = F.coalesce(F.col("local_emit"), F.col("first_emit"))
    tail = (F.when(F.col("chunk_g").isNotNull() & (F.col("chunk_g.at") > F.coalesce(chunk_emit, F.lit(-1))),
                   F.col("chunk_g.v"))
            .when(chunk_emit.isNotNull(), F.lit("")))
    s = s.withColumn("carry_group", _carry(tail))
    # chunks of no known source or place are no parts of one playlist
    named = F.col("source_name").isNotNull() & F.col("chunk").isNotNull()
    s = s.select(*KEY, *[F.when(named, F.col(c)).alias(c) for c in ("carry_eu", "carry_group", "first_emit")])

    out = t.where(F.col("kind") == "U").join(s, KEY, "left")
    prev = F.coalesce(F.col("prev_eu"), F.col("carry_eu"))
    out = out.withColumn("src", F.when((prev["kind"] == "E") & prev["valid"], prev)).where(
        F.col("src").isNotNull())
    last_emit = F.coalesce(F.col("last_emit_local"),
                           F.when(F.col("first_emit") < F.col("line_no"), F.col("first_emit")))
    local_group = (F.when(F.col("last_g").isNotNull() & (F.col("last_g.at") > F.coalesce(last_emit, F.lit(-1))),
                          F.col("last_g.v"))
                   .when(last_emit.isNotNull(), F.lit("")))
    pending = F.coalesce(local_group, F.col("carry_group"), F.lit(""))
    out = out.withColumn("attrs", extinf_attrs(extinf_blob(F.col("src.line"))))
    attrs = F.col("attrs")
    group = F.when(F.map_contains_key(attrs, "group-title"), attrs["group-title"]).otherwise(pending)
    return out.select(
        "_key.source_name",
        "entry_id",
        F.coalesce(extinf_name(F.col("src.line")), F.lit("Unknown")).alias("name"),
        F.col("line").alias("url"),
        group.alias("group_title"),
        "attrs",
    )


def with_source_attributes(entries: DataFrame, sources: DataFrame) -> DataFrame:
    """Attach ``source_weight`` and ``source_tags`` of each entry's source
    (the source registry is small; AQE broadcasts it by its runtime size)."""
    src = sources.select(F.col("name").alias("source_name"),
                         F.coalesce(F.col("weight"), F.lit(50)).cast("int").alias("source_weight"),
                         F.coalesce(F.col("tags"), F.array().cast("array<string>")).alias("source_tags"))
    return entries.join(src, "source_name", "inner")
