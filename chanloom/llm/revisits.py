"""Resolving not-modified revisit records of a web archive.

A revisit (a 304 without a body) takes the body of the latest earlier full
response with its canonical URL, if the validators agree, and the response's
headers as the revisit's permitted ones update them.

The as-of join runs on narrow rows in two levels: windows inside (URL, time
bucket), and a window over one summary row per bucket that carries the last
response into the next buckets.  A URL with a third of all captures is so
spread over its buckets: days, or minutes of a day that has too many of them,
or seconds of such a minute.  Bodies are never moved; their digests are.

Defined cases: a revisit without URL or date, or without an earlier
response, is ``no_response``; responses of one URL and moment count as the
one with the greatest record_id; a response at the revisit's own moment is
not earlier; header names compare in lower case, and null headers are none.
An empty table gives an empty result.  Revisits keep their rows: repeated
ones are resolved alike.  Other columns of the input play no part, whatever
their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: fixed values: fields that a 304 response may update in a stored response
PERMITTED = ["age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary", "warning"]
#: fixed values: statuses of a full response
FULL = [200, 203]
BUCKET_SECONDS = 86_400
#: Captures of one URL that one window may sort, and the finer ranges that a
#: fuller one is cut into.
BUCKET_ROWS = 100_000
FINER = (60, 1)
TRACKING = r"[?&](?:utm_[A-Za-z]+|gclid|fbclid)=[^&]*"


def canonical_url(url: Column) -> Column:
    """Host in lower case without www. and default port, path without
    closing slash, no scheme, fragment or tracking parameters."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_extract(bare, "^[^/?]*", 0)
    rest = F.regexp_replace(F.substr(bare, F.length(host) + 1), TRACKING, "")
    rest = F.when(rest.contains("?"), rest).otherwise(F.regexp_replace(rest, "^([^&]*)&", "$1?"))
    name = F.regexp_replace(F.regexp_replace(F.lower(host), r"^www\.", ""), ":(?:80|443)$", "")
    return F.concat(name, F.regexp_replace(rest, r"/+(\?|$)", "$1"))


def _entries(headers: Column) -> Column:
    """Header fields as an array ordered by lower-case name."""
    fields = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    return F.coalesce(F.sort_array(fields), F.array().cast("array<struct<key:string,value:string>>"))


def _field(entries: Column, name: str) -> Column:
    return F.get(F.filter(entries, lambda e: e["key"] == name), F.lit(0))["value"]


def _strong(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def _bucketed(rows: DataFrame, seconds: int, limit: int) -> DataFrame:
    """``rows`` with ``bucket``: the first second of their time range.  A
    range in which a URL has more than ``limit`` rows is cut into minutes,
    such a minute into seconds.  At most (rows / ``limit``) ranges are
    broadcast."""
    rows = rows.withColumn("bucket", F.floor(F.col("ts") / seconds) * seconds)
    for finer in [w for w in FINER if w < seconds]:
        placed = rows.where("url_key is not null and ts is not null")
        full = placed.groupBy("url_key", "bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).select("url_key", "bucket", F.lit(True).alias("full__"))
        rows = rows.join(F.broadcast(full), ["url_key", "bucket"], "left")
        rows = rows.withColumn("bucket", F.when(F.col("full__"), F.floor(F.col("ts") / finer) * finer).otherwise(F.col("bucket"))).drop("full__")
    return rows


def resolve_revisits(records: DataFrame, bucket_seconds: int = BUCKET_SECONDS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """In: record_id, type, url, ts (seconds), status, headers (map),
    payload_digest.  Out, one row per revisit: record_id, url_key, ts, state
    (resolved, mismatch, no_validator or no_response), response_id,
    payload_digest (of the body it takes), headers (lines by name)."""
    rows = records.where(F.col("type").isin("response", "revisit")).select(
        "record_id", "type", canonical_url(F.col("url")).alias("url_key"), F.col("ts").cast("long").alias("ts"), "status", _entries(F.col("headers")).alias("fields"), "payload_digest")
    full = (F.col("type") == "response") & F.col("status").isin(FULL) & F.col("url_key").isNotNull() & F.col("ts").isNotNull()
    revisit = F.col("type") == "revisit"
    rows = rows.where(full | revisit)
    rows = _bucketed(rows, bucket_seconds, bucket_rows)
    stored = F.when(~revisit, F.struct("ts", "record_id", "fields", "payload_digest"))
    placed = rows.where("url_key is not null and ts is not null")
    own = Window.partitionBy("url_key", "bucket").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumn("found", F.max(stored).over(own)).where(revisit)
    # the last response of each bucket, carried into the later ones
    last = placed.groupBy("url_key", "bucket").agg(F.max(stored).alias("newest"))
    line = Window.partitionBy("url_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("carried", F.max("newest").over(line)).select("url_key", "bucket", "carried")
    joined = inside.join(carried, ["url_key", "bucket"]).withColumn("found", F.coalesce("found", "carried")).drop("carried")
    lost = rows.where(revisit & (F.col("url_key").isNull() | F.col("ts").isNull()))
    nothing = lost.join(joined.select("found").limit(0), F.lit(False), "left").select(*joined.columns)
    joined = joined.unionByName(nothing)
    tag, old_tag = _strong(_field(F.col("fields"), "etag")), _strong(_field(F.col("found.fields"), "etag"))
    changed, old_changed = _field(F.col("fields"), "last-modified"), _field(F.col("found.fields"), "last-modified")
    agrees = F.when(tag.isNotNull(), tag == old_tag).when(changed.isNotNull(), changed == old_changed).otherwise(F.col("payload_digest") == F.col("found.payload_digest"))
    any_validator = tag.isNotNull() | changed.isNotNull() | F.col("payload_digest").isNotNull()
    state = (F.when(F.col("found").isNull(), "no_response").when(~any_validator, "no_validator")
             .when(F.coalesce(agrees, F.lit(False)), "resolved").otherwise("mismatch"))
    out = joined.withColumn("state", state)
    updates = F.filter("fields", lambda e: e["key"].isin(PERMITTED))
    names = F.transform(updates, lambda e: e["key"])
    merged = F.sort_array(F.concat(F.filter(F.col("found.fields"), lambda e: ~F.array_contains(names, e["key"])), updates))
    lines = F.array_join(F.transform(merged, lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("")))), "\n")
    ok = F.col("state") == "resolved"
    return out.select("record_id", "url_key", "ts", "state", F.when(F.col("found").isNotNull(), F.col("found.record_id")).alias("response_id"),
                      F.when(ok, F.col("found.payload_digest")).alias("payload_digest"), F.when(ok, lines).alias("headers"))


def page_records(pages: DataFrame) -> DataFrame:
    """Archive records of a crawl of ``pages``: a full response per page, and
    a revisit of it some hours or days later under a variant of its URL.
    Every seventh revisit has another ETag, every fifth only a Last-Modified,
    every eleventh no validator at all."""
    n = F.col("page_id")
    hex_digest = F.sha2(F.coalesce(F.col("html"), F.lit("")), 256)
    at = F.lit(1_700_000_000) + F.pmod(n * 7919, F.lit(2_592_000))
    stamp = lambda t: F.concat(F.lit("t"), t.cast("string"))
    tag = F.concat(F.lit('"'), F.left(hex_digest, F.lit(16)), F.lit('"'))
    response = pages.select(
        F.concat(F.lit("response:"), n.cast("string")).alias("record_id"), F.lit("response").alias("type"), "url", at.alias("ts"), F.lit(200).alias("status"),
        F.map_from_arrays(F.array(*[F.lit(k) for k in ("Content-Type", "Content-Length", "ETag", "Last-Modified", "Cache-Control", "Date")]),
                          F.array(F.lit("text/html"), F.length(F.coalesce(F.col("html"), F.lit(""))).cast("string"), tag, stamp(F.floor(at / 1000) * 1000), F.lit("max-age=60"), stamp(at))).alias("headers"),
        hex_digest.alias("payload_digest"))
    later = at + 3_600 + F.pmod(n * 104_729, F.lit(864_000))
    seen = F.when(n % 11 == 0, F.lit(None)).when(n % 5 == 0, F.lit(None)).when(n % 7 == 0, F.lit('W/"other"')).otherwise(F.concat(F.lit("W/"), tag))
    since = F.when(n % 11 == 0, F.lit(None)).otherwise(stamp(F.floor(at / 1000) * 1000))
    fields = F.filter(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in (
        ("etag", seen), ("last-modified", since), ("cache-control", F.lit("max-age=120")), ("date", stamp(later)), ("content-length", F.lit("0")), ("set-cookie", F.lit("s=1")))]),
        lambda e: e["value"].isNotNull())
    revisit = pages.select(
        F.concat(F.lit("revisit:"), n.cast("string")).alias("record_id"), F.lit("revisit").alias("type"), F.concat(F.col("url"), F.lit("#again")).alias("url"), later.alias("ts"),
        F.lit(304).alias("status"), F.map_from_entries(fields).alias("headers"), F.lit(None).cast("string").alias("payload_digest"))
    return response.unionByName(revisit)


#: The same records and their resolution in DuckDB SQL.
ORACLE_SQL = r"""
WITH p AS (
  SELECT page_id AS n, url, sha256(coalesce(html, '')) AS digest, length(coalesce(html, '')) AS size,
         1700000000 + (page_id * 7919) % 2592000 AS at_
  FROM pages),
k AS (
  SELECT *, regexp_extract(bare, '^[^/?]*', 0) AS host FROM (
    SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM p)),
u AS (
  SELECT *, regexp_replace(regexp_replace(lower(host), '^www\.', ''), ':(80|443)$', '') ||
         regexp_replace(CASE WHEN contains(rest, '?') THEN rest ELSE regexp_replace(rest, '^([^&]*)&', '\1?') END, '/+(\?|$)', '\1', 'g') AS url_key
  FROM (SELECT *, regexp_replace(bare[length(host) + 1:], '[?&](utm_[A-Za-z]+|gclid|fbclid)=[^&]*', '', 'g') AS rest FROM k)),
responses AS (
  SELECT url_key, at_ AS ts, max('response:' || n) AS response_id, arg_max(digest, 'response:' || n) AS digest,
         arg_max(size, 'response:' || n) AS size
  FROM u GROUP BY ALL),
revisits AS (SELECT n, url_key, digest AS own, at_ // 1000 * 1000 AS since, at_ + 3600 + (n * 104729) % 864000 AS ts FROM u),
j AS (
  SELECT r.*, s.response_id, s.digest, s.size, s.ts AS then_
  FROM revisits r ASOF LEFT JOIN responses s ON r.url_key = s.url_key AND r.ts > s.ts),
c AS (
  SELECT *, CASE
    WHEN response_id IS NULL THEN 'no_response'
    WHEN n % 11 = 0 THEN 'no_validator'
    WHEN n % 5 = 0 THEN CASE WHEN since = then_ // 1000 * 1000 THEN 'resolved' ELSE 'mismatch' END
    WHEN n % 7 = 0 THEN 'mismatch'
    WHEN own[:16] = digest[:16] THEN 'resolved' ELSE 'mismatch' END AS state
  FROM j)
SELECT 'revisit:' || n AS record_id, url_key, ts, state, response_id,
       CASE WHEN state = 'resolved' THEN digest END AS payload_digest,
       CASE WHEN state = 'resolved' THEN
         'cache-control: max-age=120' || chr(10) || 'content-length: ' || size || chr(10) || 'content-type: text/html' || chr(10) ||
         'date: t' || ts || chr(10) || 'etag: ' || CASE WHEN n % 5 = 0 THEN '"' ELSE 'W/"' END || digest[:16] || '"' || chr(10) ||
         'last-modified: t' || since END AS headers
FROM c
"""
