"""Derived test relations over the driver tables.

The engine's native inputs are playlists, rule tables and captured HTTP
samples.  The check tables are TPC-H-like, so these functions derive
channel-shaped relations from them (see FIXTURES.md, section 3).  Every
relation is computed by Spark from the whole tables; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import Profile
from ..operators.rule_tables import keyword_table, rule_table
from .tables import read_table  # noqa: F401  (re-exported)

#: Entries that a task makes.
TASK_ROWS = 400_000

# Rule set of the fixtures (FIXTURES.md section 4), in priority order.
FIXTURE_COUNTRIES = [
    {"id": "az", "title": "Azerbaijan", "tvg_id_suffixes": [".az"], "tlds": [".az"],
     "keywords": ["widget"], "source_tags": ["NATION_0"]},
    {"id": "tr", "title": "Turkey", "tvg_id_suffixes": [".tr"], "tlds": [".tr"],
     "keywords": ["bolt"], "source_tags": ["NATION_1"]},
    {"id": "ru", "title": "Russia", "tvg_id_suffixes": [".ru"], "tlds": [".ru"],
     "keywords": ["gear"], "source_tags": ["NATION_2"]},
    {"id": "en", "title": "English", "tvg_id_suffixes": [".uk", ".us"], "tlds": [".uk", ".us"],
     "keywords": ["ring"], "source_tags": ["NATION_3"]},
]
FIXTURE_CATEGORIES = [
    {"id": "tools", "title": "Tools", "keywords": ["anvil", "bolt"]},
    {"id": "parts", "title": "Parts", "keywords": ["gear", "ring"]},
    {"id": "promo", "title": "Promo", "keywords": ["promo"], "source_tags": ["NATION_4"]},
]
FIXTURE_UNWANTED = ["hot", "18+"]
FIXTURE_DENY_MARKERS = ["track(", "access denied", "forbidden"]

FIXTURE_PROFILE = Profile(
    countries=FIXTURE_COUNTRIES,
    categories=FIXTURE_CATEGORIES,
    unwanted_keywords=FIXTURE_UNWANTED,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _url(pk: Column, s10: Column) -> Column:
    scheme = F.when((pk + s10) % 3 == 0, "http").otherwise("https")
    tld = (F.when(s10 % 6 == 0, "az").when(s10 % 6 == 1, "tr").when(s10 % 6 == 2, "ru")
           .when(s10 % 6 == 3, "uk").otherwise("org"))
    return F.concat(scheme, F.lit("://cdn"), _s(s10), F.lit(".example."), tld,
                    F.lit("/live/"), _s(pk), F.lit(".m3u8"))


def _probe_key(spark: SparkSession, sf_dir: str, pk: Column, s10: Column) -> Column:
    users = read_table(spark, sf_dir, "events", ["user_id"]).agg(F.count_distinct("user_id").alias("n")).scalar()
    return F.pmod(pk * 31 + s10, F.greatest(users, F.lit(1))).cast("int")


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """Narrow table rows dealt out over tasks (a file of one row group is one
    task).  They become ten times wider once they are entries, so the parts
    of a large table are counted in rows; their bytes would make them too few.
    A large table is dealt by the key of its next join, which then needs no
    exchange of its own (it drops rows without a key).  Where a key has more
    rows than a part, its rows are dealt by all columns."""
    total = rows.count()
    parts = total // TASK_ROWS
    if parts <= rows.sparkSession.sparkContext.defaultParallelism:
        return rows.repartition(*rows.columns)
    # groups of keys are counted first: few groups, and only one with a frequent key is that large
    group = F.pmod(F.xxhash64(key), F.lit(16 * parts)).alias("g")
    given = rows.where(F.col(key).isNotNull())
    n = F.count(F.lit(1)).alias("n")
    large = [r["g"] for r in given.groupBy(group).agg(n).where(F.col("n") > TASK_ROWS).collect()]
    hot = large and [r[key] for r in given.where(group.isin(large)).groupBy(key).agg(n).where(F.col("n") > TASK_ROWS).collect()]
    if not hot:
        return rows.repartition(parts, key)
    spread = F.when(F.col(key).isNull() | F.col(key).isin(hot), F.xxhash64(*rows.columns))
    return rows.repartition(parts, F.col(key), spread)


def entries(spark: SparkSession, sf_dir: str, ids: DataFrame | None = None) -> DataFrame:
    """F-A: one channel entry per lineitem row.

    Columns: entry_id, source_name, source_weight, source_tags, name, url,
    group_title, attrs (tvg-id / tvg-name / tvg-logo), probe_key.  ``ids``
    (entry_id): only these entries, looked up where the rows are read; 0 finds
    the entries without an id as well, as no id does.
    """
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    li = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("entry_id"), "l_partkey", "l_suppkey")
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_brand", "p_type")
    if ids is None:
        li = _dealt(li, "l_partkey")
    else:
        # one number is a cheaper key than a null-safe comparison
        known = F.coalesce(F.col("entry_id"), F.lit(0))
        li = li.join(ids.select(known.alias("_id")), known == F.col("_id"), "left_semi")
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    j = li.join(pa, li.l_partkey == pa.p_partkey).join(su, li.l_suppkey == su.s_suppkey)
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    tvg_id = F.when(pk % 4 == 0, F.concat(
        F.lit("P"), _s(pk), F.lit("."),
        F.when(sk % 3 == 0, "az").when(sk % 3 == 1, "tr@SD").otherwise("zz"))).otherwise("")
    tvg_name = F.when(pk % 5 == 0, F.col("p_brand")).otherwise("")
    tvg_logo = F.when(sk % 2 == 0, F.concat(F.lit("http://logo.example.org/"), _s(pk), F.lit(".png"))
                      ).otherwise("")
    return j.select(
        "entry_id",
        F.col("s_name").alias("source_name"),
        (F.lit(50) + sk % 51).cast("int").alias("source_weight"),
        F.array(F.concat(F.lit("NATION_"), _s(F.col("s_nationkey")))).alias("source_tags"),
        F.concat(F.col("p_name"), F.lit(" "), _s(F.col("p_size"))).alias("name"),
        _url(pk, sk % 10).alias("url"),
        F.col("p_type").alias("group_title"),
        F.create_map(F.lit("tvg-id"), tvg_id, F.lit("tvg-name"), tvg_name,
                     F.lit("tvg-logo"), tvg_logo).alias("attrs"),
        _probe_key(spark, sf_dir, pk, sk % 10).alias("probe_key"),
    )


def entry_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (url, probe_key) of F-A: both come from the part and the last
    digit of the supplier, so copies go before any text is made, in one
    exchange."""
    li = read_table(spark, sf_dir, "lineitem", ["l_partkey", "l_suppkey"])
    pa = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"))
    su = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"))
    kept = li.join(su, "l_suppkey", "left_semi").select("l_partkey", (F.col("l_suppkey") % 10).alias("s10")).distinct()
    pairs = kept.join(pa, "l_partkey", "left_semi")
    pk, s10 = F.col("l_partkey"), F.col("s10")
    return pairs.select(_url(pk, s10).alias("url"), _probe_key(spark, sf_dir, pk, s10).alias("probe_key"))


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source registry derived from ``supplier`` (one playlist per supplier)."""
    su = table(spark, sf_dir, "supplier")
    return su.select(
        F.col("s_name").alias("name"),
        F.concat(F.lit("https://lists.example.org/"), _s(F.col("s_suppkey")), F.lit(".m3u")).alias("url"),
        (F.col("s_suppkey") % 7 != 3).alias("enabled"),
        (F.lit(50) + F.col("s_suppkey") % 51).cast("int").alias("weight"),
        F.array(F.concat(F.lit("NATION_"), _s(F.col("s_nationkey")))).alias("tags"),
    )


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-E: the fetch of every source: one in 11 failed, one in 17 was never
    tried, and one in 13 of the others has an empty playlist."""
    sk = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").where(sk % 17 != 7)
    return rows.select(
        F.col("s_name").alias("source_name"),
        F.when(sk % 11 == 5, "HTTP Error 404").otherwise("").alias("error"),
        F.when(sk % 5 != 0, sk * 37 % 900).cast("int").alias("elapsed_ms"),
        (sk % 13 == 4).alias("empty"))


def landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-C lines of the playlists that were fetched and are not empty."""
    landed = fetch_log(spark, sf_dir).where("error = '' and not empty").select("source_name")
    return playlist_lines(spark, sf_dir).join(landed, "source_name", "left_semi")


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-B: probe attempts per probe key, from ``events``."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    level = (F.when(F.col("event_type") == "purchase", 3).when(F.col("event_type") == "signup", 2)
             .when(F.col("event_type") == "view", 1).otherwise(0))
    return ev.select(
        F.col("user_id").cast("int").alias("probe_key"),
        F.row_number().over(w).cast("int").alias("attempt"),
        level.alias("check_level"),
        F.when(level >= 1, 200).otherwise(503).cast("int").alias("status_code"),
        F.floor(F.col("value") * 100).cast("int").alias("latency_ms"),
        F.col("event_type").alias("error"),
    )


def url_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts keyed by URL: every URL of F-A gets the attempts of its key."""
    urls = entry_urls(spark, sf_dir)
    return urls.join(attempts(spark, sf_dir), "probe_key").drop("probe_key")


def playlist_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-C: playlist lines per source with EXTGRP, EXTINF, comments, URLs."""
    e = entries(spark, sf_dir)
    w = Window.partitionBy(F.xxhash64("source_name"), "source_name").orderBy(
        "url", F.col("attrs")["tvg-id"], F.col("attrs")["tvg-logo"], "entry_id")
    n = e.select("source_name", "url", "name", "group_title",
                 F.col("attrs")["tvg-id"].alias("tvg_id"),
                 F.row_number().over(w).cast("long").alias("k"))
    k = F.col("k")

    def line(cond, offset, text):
        return F.when(cond, F.struct((k * 10 + offset).alias("line_no"), text.alias("line")))

    extinf = F.when(k % 11 == 0, F.lit("#EXTINF:abc,bad")).otherwise(F.concat(
        F.lit('#EXTINF:-1 tvg-id="'), F.col("tvg_id"), F.lit('"'),
        F.when(k % 2 == 0, F.concat(F.lit(' group-title="'), F.col("group_title"), F.lit('"')))
        .otherwise(F.lit("")),
        F.lit(","), F.col("name")))
    # All lines of one entry come from one row (one pass over the entries).
    lines = F.array(
        line(k % 5 == 0, 0, F.concat(F.lit("#EXTGRP:G"), _s(k % 13))),
        line(k % 7 != 0, 1, extinf),
        line(k % 3 == 0, 2, F.lit("#EXTVLCOPT:x")),
        line(F.lit(True), 3, F.col("url")))
    return (n.select("source_name", F.explode(F.filter(lines, lambda x: x.isNotNull())).alias("x"))
            .select("source_name", "x.line_no", "x.line"))


def http_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-D: captured responses for entry, child and segment URLs."""
    u = entry_urls(spark, sf_dir).select("url", F.col("probe_key").alias("k"),
                                         F.regexp_extract("url", "^(https?://[^/]+)", 1).alias("o"))
    k = F.col("k")
    nl = F.lit("\n")
    entry_body = (F.when(k % 10 == 0, "").when(k % 10 == 1, "<html>Access Denied</html>")
                  .when(k % 10 == 2, "data").when(k % 10 == 3, "#EXTM3U")
                  .when(k % 10 == 4, F.concat(F.lit("#EXTM3U"), nl, F.lit("rtmp://x.example.org/y")))
                  .otherwise(F.concat(F.lit("#EXTM3U"), nl, F.lit("#EXT-X"), nl,
                                      F.lit("/child/"), _s(k), F.lit(".m3u8"))))
    top = u.select(
        "url",
        F.when(k % 10 == 0, 404).otherwise(200).alias("status"),
        F.when(k % 10 == 1, "text/html").when(k % 10 == 2, "video/mp2t")
        .otherwise("application/vnd.apple.mpegurl").alias("content_type"),
        entry_body.alias("body"))
    child = u.where(k % 10 >= 5).select(
        F.concat("o", F.lit("/child/"), _s(k), F.lit(".m3u8")).alias("url"),
        F.when(k % 10 == 5, 403).otherwise(200).alias("status"),
        F.when(k % 10 == 6, "video/mp2t").otherwise("application/vnd.apple.mpegurl").alias("content_type"),
        F.when(k % 10 == 6, "data").when(k % 10 == 7, "#EXTM3U")
        .when(k % 10 >= 8, F.concat(F.lit("#EXTM3U"), nl, F.lit("seg"), _s(k), F.lit(".ts")))
        .otherwise("").alias("body")).distinct()
    seg = u.where(k % 10 >= 8).select(
        F.concat("o", F.lit("/child/seg"), _s(k), F.lit(".ts")).alias("url"),
        F.when(k % 10 == 9, 500).otherwise(200).alias("status"),
        F.lit("video/mp2t").alias("content_type"), F.lit("data").alias("body")).distinct()
    # Two attempts: one URL in 13 times out first, one in 17 is only there at first.
    digit = F.length("url") * 7 + F.ascii(F.substring(F.md5("url"), 1, 1))
    out = top.unionByName(child).unionByName(seg).select("*", digit.alias("h")).select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("attempt"))
    h = F.col("h")
    timeout = (h % 13 == 0) & (F.col("attempt") == 1)
    gone = (h % 17 == 0) & (F.col("attempt") == 2)
    return out.select(
        "url", "attempt",
        F.when(timeout, F.lit(None)).when(gone, F.lit(410)).otherwise(F.col("status")).cast("int").alias("status"),
        "content_type", F.when(~timeout, F.encode("body", "UTF-8")).alias("body"),
        F.when(timeout, F.lit("timed out")).otherwise(F.lit("")).alias("error"),
        F.when(h % 19 != 0, h * 3 + F.col("attempt")).cast("int").alias("elapsed_ms"))


def overrides_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name overrides derived from ``part``: position, key, country,
    categories, new name (empty = keep).  Several raw keys may normalise to
    the same name; the lowest position wins."""
    pa = table(spark, sf_dir, "part")
    key = F.concat(F.upper(F.col("p_name")), F.lit(" "), _s(F.col("p_size")))
    return pa.where((F.col("p_size") % 9 == 0)).select(
        F.col("p_partkey").alias("position"),
        key.alias("key"),
        F.when(F.col("p_size") % 2 == 0, F.lit("tr")).otherwise(F.lit("")).alias("country"),
        F.when(F.col("p_size") % 4 == 0, F.array(F.lit("zeta"), F.lit("alpha")))
        .otherwise(F.array().cast("array<string>")).alias("categories"),
        F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("Renamed "), F.col("p_brand")))
        .otherwise(F.lit("")).alias("name"),
    )


def overrides_by_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL overrides derived from ``part``: every https cdn0 URL of a part."""
    pa = table(spark, sf_dir, "part")
    return pa.where(F.col("p_size") % 10 == 1).select(
        F.concat(F.lit("https://cdn1.example.tr/live/"), _s(F.col("p_partkey")), F.lit(".m3u8")).alias("url"),
        F.lit("ru").alias("country"),
        F.array(F.lit("promo")).alias("categories"),
        F.lit("").alias("name"),
    )


def _quoted(text: Column) -> Column:
    """A JSON string."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def override_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-G: one overrides document (JSON text) per part, with a value that is
    no object (p_size % 3 = 0) and a repeated key (p_size % 5 = 0)."""
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    size = F.col("p_size")
    fields = F.concat(F.lit('{"country":'), F.when(size % 2 == 0, F.lit('"tr"')).otherwise(F.lit("null")), F.lit(',"categories":['),
                      F.when(size % 4 == 0, F.concat(F.lit('"zeta",'), _s(size))).otherwise(F.lit("")), F.lit("]}"))
    kind = F.when(size % 3 == 0, _s(size)).otherwise(F.lit('{"country": "ru", "name": ""}'))
    again = F.when(size % 5 == 0, F.concat(F.lit(", "), _quoted(F.col("p_name")), F.lit(': {"name": '), _quoted(F.col("p_brand")), F.lit("}"))).otherwise(F.lit(""))
    by_url = F.concat(F.lit('"http://u/'), _s(F.col("p_partkey")), F.lit('": {"categories": ["promo"], "extra": {"a": [1, 2]}}'))
    value = F.concat(F.lit('{"version": 1, "by_name": {'), _quoted(F.col("p_name")), F.lit(": "), fields, F.lit(", "), _quoted(F.col("p_type")), F.lit(": "),
                     kind, again, F.lit('}, "by_url": {'), by_url, F.lit("}}"))
    return pa.select("p_partkey", value.alias("value"))


def registry_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-H: one source registry document (JSON text) per supplier: the source
    itself, one without a name, and a mirror with defaults."""
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    key = _s(F.col("s_suppkey"))
    own = F.concat(F.lit('{"name": '), _quoted(F.col("s_name")), F.lit(', "url": "https://lists.example.org/'), key, F.lit('.m3u", "enabled": '),
                   F.when(F.col("s_suppkey") % 7 != 3, F.lit("true")).otherwise(F.lit("false")), F.lit(', "weight": '), _s(F.lit(50) + F.col("s_suppkey") % 51),
                   F.lit(', "tags": ["NATION_'), _s(F.col("s_nationkey")), F.lit('", "all"]}'))
    mirror = F.concat(F.lit('{"name": "mirror-'), key, F.lit('", "url": "'), F.when(F.col("s_suppkey") % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("http://m/"), key)), F.lit('"}'))
    value = F.concat(F.lit('{"sources": ['), own, F.lit(', {"name": "", "url": "http://none"}, '), mirror, F.lit("]}"))
    return su.select("s_suppkey", value.alias("value"))


def rule_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """F-I: rule tables (kind, position, value, rule_id) from every part,
    before the few rules of the fixture profile."""
    pa = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    key, size = F.col("p_partkey"), F.col("p_size")

    def rules(items: list[tuple[str, int, Column, Column, Column]]) -> DataFrame:
        rows = [F.when(applies, F.struct(F.lit(kind).alias("kind"), (key * 8 + place).cast("long").alias("position"), value.alias("value"), rule_id.alias("rule_id")))
                for kind, place, value, rule_id, applies in items]
        return pa.select(F.explode(F.array_compact(F.array(*rows))).alias("x")).select("x.*")

    def after(rows: DataFrame) -> DataFrame:
        return rows.withColumn("position", F.col("position") + 10**12)

    always = F.lit(True)
    title = F.concat(F.upper("p_name"), F.lit("-"), _s(size))
    country = F.concat(F.lit("c"), _s(key % 97))
    countries = rules([
        ("keyword", 0, title, country, size % 4 != 0),
        ("keyword", 1, F.concat(F.lit("P"), _s(key), F.lit(".ZZ")), F.concat(F.lit("z"), _s(key % 7)), always),
        ("keyword", 2, F.concat(F.col("p_brand"), F.lit(" p"), _s(key)), F.concat(F.lit("b"), _s(key % 11)), always),
        ("keyword", 3, F.concat(_s(size), F.lit(" "), F.col("p_type")), F.concat(F.lit("t"), _s(key % 5)), size % 7 == 0),
        ("keyword", 4, _s(size), F.lit("short"), size == 49),
        ("suffix", 5, F.concat(F.lit("P"), _s(key), F.lit(".zz")), F.concat(F.lit("s"), _s(key % 3)), size % 10 == 0),
    ])
    categories = rules([
        ("keyword", 0, title, F.concat(F.lit("k"), _s(key % 13)), size % 3 != 0),
        ("keyword", 1, F.concat(F.col("p_type"), F.lit(" "), F.col("p_brand")), F.concat(F.lit("m"), _s(key % 9)), key % 5 == 0),
        ("tag", 2, F.concat(F.lit("nation_"), _s(key % 25)), F.concat(F.lit("n"), _s(key % 4)), size == 1),
    ])
    unwanted = rules([("keyword", 0, F.concat(F.col("p_name"), F.lit(" "), _s(size)), F.lit(""), size % 6 == 0)])
    return {"countries": countries.unionByName(after(rule_table(spark, FIXTURE_COUNTRIES, "other"))),
            "categories": categories.unionByName(after(rule_table(spark, FIXTURE_CATEGORIES, "general"))),
            "unwanted": unwanted.unionByName(after(keyword_table(spark, FIXTURE_UNWANTED)))}
