"""Steps whose cost must grow no faster than their input."""

import random
from collections import Counter

from pyspark.sql import functions as F

import __spark_entry__ as entry
from chanloom.functions import text as TX
from chanloom.functions import urls as U
from chanloom.operators import classify as CL
from chanloom.operators import dedupe as D
from chanloom.operators import parse as P
from chanloom.operators import probe as PR
from chanloom.operators import rule_tables as RT
from chanloom.plans import build as B
from chanloom.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def test_numbered_patterns_meet_their_own_texts(spark):
    """Thousands of numbers over few digits share their short grams, so a
    pattern keyed by four characters met dozens of texts."""
    random.seed(7)
    numbers = sorted({"".join(random.choices("0123", k=8)) for _ in range(3000)})
    patterns = spark.createDataFrame([(f"p{n} zz", i) for i, n in enumerate(numbers)], "text string, rule long")
    values = spark.createDataFrame([(f"some name p{n} zz cdn",) for n in numbers], "value string")
    assert RT.candidates(values, patterns).count() < 3 * len(numbers)
    assert sorted(tuple(r) for r in RT.matching(values, patterns).select("value", "text").collect()) == sorted((f"some name p{n} zz cdn", f"p{n} zz") for n in numbers)


def test_patterns_of_every_length(spark):
    text = "abcdefghijklmnopqrstuvwxyzабвгд"
    pieces = [text[a:a + n] for n in range(1, 25) for a in (0, 3, len(text) - n)]
    wrong = [p[:-1] + "!" for p in pieces if len(p) > 1]
    patterns = spark.createDataFrame([(p, True) for p in {*pieces, *wrong}], "text string, rule boolean")
    values = spark.createDataFrame([(text,), ("zz",), ("a",)], "value string")
    got = {r.text for r in RT.matching(values, patterns).where(F.col("value") == text).collect()}
    assert got == {p for p in {*pieces, *wrong} if p in text}
    ends = {r.text for r in RT.matching(values, patterns, at_end=True).where(F.col("value") == text).collect()}
    assert ends == {p for p in pieces if text.endswith(p)}


def test_fields_are_normalised_once_per_combination(spark):
    """Rows of the entries are not normalised again when results return."""
    for name in ("classify_country_table", "classify_categories_table", "content_filter_table"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" not in plan, name


def test_keywords_meet_fields_not_texts(spark, monkeypatch):
    """A channel under many hosts and names has as many texts; their grams
    filled the disk.  Only the distinct fields are taken apart."""
    seen, candidates = [], RT.candidates
    monkeypatch.setattr(RT, "candidates", lambda values, *more: seen.append(values.count()) or candidates(values, *more))
    rows = [("s", i, f"name {i % 20}", f"http://h{i // 400}.az/{i}", "news", {"tvg-id": f"p{i // 20 % 20}.tr", "tvg-name": "b"}, 50, None) for i in range(4000)]
    df = spark.createDataFrame(rows, "source_name string, entry_id long, name string, url string, group_title string, attrs map<string,string>, source_weight int, source_tags array<string>")
    rules = spark.createDataFrame([("keyword", i, k, f"r{i}") for i, k in enumerate(["name 7", "b p3", "p11 t", "9 news b", "tr h5"])], RT.SCHEMA)
    got = RT.country_by_tables(CL.with_normalized(df), rules).groupBy("country").count().collect()

    def rule(i):
        text = f"name {i % 20} news b p{i // 20 % 20} tr h{i // 400} az"
        return next((f"r{n}" for n, k in enumerate(["name 7", "b p3", "p11 t", "9 news b", "tr h5"]) if k in text), "other")

    assert {r.country: r["count"] for r in got} == dict(Counter(map(rule, range(4000))))
    assert seen and max(seen) < 100


def test_references_are_resolved_where_samples_are_scanned(spark):
    rows = [("http://a/x/1", 1, 200, "", b"#EXTM3U\n../c", "", 5), ("http://a/2", 1, 200, "", b"", "", 5), (None, 1, 200, "", b"c", "", 5)]
    s = spark.createDataFrame(rows, "url string, attempt int, status int, content_type string, body binary, error string, elapsed_ms int")
    assert {r.url: r.next for r in PR.sample_facts(s).select("url", "fact.next").collect()} == {"http://a/x/1": "http://a/c", "http://a/2": None, None: None}
    plan = PR.probe_levels(s, s.select("url"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" not in plan


def test_lines_of_a_longer_plan_are_read_once(spark):
    """Both levels of the parse read one exchange, also when the lines come
    from joins."""
    df = P.m3u_parse(FX.playlist_lines(spark, SF))
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_no_state_is_carried_without_a_source(spark):
    rows = [(s, n, t) for s in ("s", None) for n, t in ((0, "#EXTGRP:g"), (1, "#EXTINF:-1,A"), (2, "http://a"), (3, " #EXTINF:-1,B"), (4, "#c"), (5, "  "), (6, "http://b "))]
    lines = spark.createDataFrame(rows, "source_name string, line_no long, line string")
    got = sorted(((r.source_name, r.entry_id, r.name, r.group_title) for r in P.m3u_parse(lines, 3).collect()), key=str)
    assert got == [("s", 2, "A", "g"), ("s", 6, "B", ""), (None, 2, "A", "g")]


def _entries(spark):
    names = ["Widget TV", "Hot TV", "Ring", "bolt 1", "Größe", ""]
    rows = [(f"s{i % 3}", i, names[i % 6], f"http://u{i % 4}.az/{i % 40}", names[i * 5 % 6], {"tvg-id": f"x{i}.tr" if i % 7 == 0 else "", "tvg-name": names[i % 5]} if i % 4 else {}, 50 + i % 9,
             ["NATION_1"] if i % 6 == 0 else None) for i in range(300)]
    return spark.createDataFrame(rows, "source_name string, entry_id long, name string, url string, group_title string, attrs map<string,string>, source_weight int, source_tags array<string>")


def test_winners_are_classified(spark):
    """The same channels, and nothing but the winners is classified."""
    e = _entries(spark)
    want = B.selected_channels(B.prepared_entries(e, FX.FIXTURE_PROFILE), FX.FIXTURE_PROFILE)
    got = B.select_entries(e, FX.FIXTURE_PROFILE)
    assert set(got.columns) == set(want.columns)
    columns = [c for c in want.columns if c != "attrs"]
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, want.select(columns).collect()))
    tree = got._jdf.queryExecution().optimizedPlan().toString()
    assert "AS country" in tree and "AS country" not in tree[tree.index("Window"):]
    by_name = spark.createDataFrame([("Ring", "tr", ["zeta"], "Hot 2")], "key string, country string, categories array<string>, name string")
    names = {r.name for r in B.select_entries(e, FX.FIXTURE_PROFILE, by_name).collect()}
    assert not names & {"Ring", "Hot 2"}


def test_only_tried_urls_are_reported(spark):
    selected = B.select_entries(_entries(spark), FX.FIXTURE_PROFILE).localCheckpoint()
    tried = {u for r in selected.collect() for u in [r.url, *r.fallback_urls[:FX.FIXTURE_PROFILE.max_fallbacks]]}
    urls = sorted(tried) + [f"http://other/{i}" for i in range(50)]
    attempts = spark.createDataFrame([(u, a, a, 200, 9, "") for u in urls for a in (1, 2)], "url string, attempt int, check_level int, status_code int, latency_ms int, error string")
    report = B.health_stage(selected, attempts, FX.FIXTURE_PROFILE).report
    assert sorted(r.url for r in report.collect()) == sorted(tried)


def test_distinct_urls_of_entries(spark, tmp_path):
    """Repeated and null keys, parts and suppliers that are missing."""
    tables = {
        "lineitem": ([(i, i % 4, None if i % 11 == 0 else i % 9, None if i % 13 == 0 else i % 25) for i in range(300)], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long"),
        "part": ([(k, f"n{k}", "B", "T", k) for k in [None, 1, 2, 2, 3, 4, 7]], "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        "supplier": ([(k, f"s{k}", 1) for k in [None, 0, 3, 3, 10, 13, 21]], "s_suppkey long, s_name string, s_nationkey int"),
        "events": ([(i % 17,) for i in range(40)], "user_id long"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    want = FX.entries(spark, str(tmp_path)).select("url", "probe_key").distinct()
    got = FX.entry_urls(spark, str(tmp_path))
    assert want.count() > 10 and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_names_are_normalised_once_per_url(spark):
    """The filter runs where the texts come from; between the joins and the
    URL window no row goes through Python."""
    tree = B.select_entries(FX.entries(spark, SF), FX.FIXTURE_PROFILE)._jdf.queryExecution().optimizedPlan().toString()
    below = tree[tree.rindex("Window"):]
    assert "ArrowEvalPython" not in below[:below.index("Join")]
    assert "ArrowEvalPython" in below


def test_a_key_is_one_pass(spark):
    texts = ["Größe Ⅳ", "ﬁne TV", "plain", "--", "", None, "①", "Σ σς", "∴"]
    rows = [(i, a, b, c) for i, (a, b, c) in enumerate((a, b, c) for a in texts for b in texts for c in texts)]
    df = spark.createDataFrame(rows, "i long, name string, tvg string, url string")
    df = df.select("i", "name", F.when(F.col("i") % 5 != 0, F.create_map(F.lit("tvg-name"), F.col("tvg"))).alias("attrs"), "url")
    keyed = D.with_dedupe_key(df)
    want = {i: TX.normalize_py(a) or TX.normalize_py(b if i % 5 else None) or TX.normalize_py(c) for i, a, b, c in rows}
    assert {r.i: r.dedupe_key for r in keyed.collect()} == want
    both = D.with_dedupe_key(df.withColumn("norm_name", TX.normalize_text("name")))
    assert {r.i: r.dedupe_key for r in both.collect()} == want
    assert keyed.select("dedupe_key")._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_entries_are_dealt_by_rows(spark, monkeypatch):
    """Parts of a large table follow its rows: an adaptive shuffle makes few,
    since the rows are narrow until they are joined."""
    few = FX.entries(spark, SF)
    columns = [c for c in few.columns if c != "attrs"]
    monkeypatch.setattr(FX, "TASK_ROWS", 150)
    many = FX.entries(spark, SF)
    assert many.rdd.getNumPartitions() == 40
    assert sorted(map(str, many.select(columns).collect())) == sorted(map(str, few.select(columns).collect()))


def test_copies_of_a_part_meet_before_the_exchange(spark, tmp_path, monkeypatch):
    """Parts of a large table hold whole join keys, except keys with more
    rows than a part and rows without a key, which are dealt out."""
    rows = [(i, i % 4, 7 if i % 3 == 0 else None if i % 3 == 1 else 100 + i % 300, i % 25) for i in range(6000)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    li = spark.read.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(FX, "TASK_ROWS", 300)
    dealt = FX._dealt(li, "l_partkey")
    at = dealt.groupBy("l_partkey", F.spark_partition_id().alias("part")).count().collect()
    assert sorted(map(tuple, dealt.collect()), key=str) == sorted(rows, key=str)
    parts = {}
    for r in at:
        parts.setdefault(r.l_partkey, []).append(r["count"])
    assert len(parts[7]) == len(parts[None]) == 20 and max(parts[7] + parts[None]) < 300
    assert all(len(n) == 1 for k, n in parts.items() if k not in (7, None))
    # without such a key the join brings no exchange of its own
    even = FX._dealt(li.where("l_partkey <> 7 and l_partkey is not null").localCheckpoint(), "l_partkey")
    assert even.rdd.getNumPartitions() == 6
    plan = even.join(li.select(F.col("l_partkey").alias("p")).hint("merge"), F.col("l_partkey") == F.col("p"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and plan.count("REPARTITION_BY_NUM") == 1


def test_https_is_the_scheme(spark):
    urls = ["https://a", "http://a", "HTTPS://a", " https://a", "ht\ntps://a", "https", "httpsx://a", "https:", "http:", "ftp://a", "", "\x01https://a", "\u00a0https://a", "https+x://a", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [tuple(r) for r in df.select(U.is_https("url"), U.url_scheme("url") == "https").collect()] == [(w, w) for w in map(lambda r: r[0], df.select(U.url_scheme("url") == "https").collect())]


def test_a_key_normalises_one_text(spark):
    """Every character whose text stays in the JVM, and one pattern pass."""
    texts = [c for c in map(chr, range(0x530)) if TX._safe(c)]
    df = spark.createDataFrame([(t, f" {t}-", "x") for t in texts], "a string, b string, c string")
    want = [TX.normalize_py(t) or "x" for t in texts]
    assert [r[0] for r in df.select(TX.first_normal(F.col("a"), F.col("b"), F.col("c"))).collect()] == want
    assert [r[0] for r in df.select(TX.first_normal(F.lit(None).cast("string"), F.col("b"), F.col("c"))).collect()] == want
    tree = df.select(TX.first_normal(F.col("a"), F.col("b"), F.col("c")).alias("k"))._jdf.queryExecution().optimizedPlan().toString()
    assert tree.count("regexp_replace") == 1


def _repeated(spark):
    """Entries with copies, nulls in every column and names that are blank,
    wide or shared; copies differ in nothing but their tags."""
    names = ["Widget TV", "widget-tv", "Ring", "--", "Größe", "", None, "①", "Hot TV", "\u2117"]
    rows = []
    for i in range(600):
        url = None if i % 41 == 0 else f"http{'s' if i % 3 else ''}://u{i % 7}.az/{i % 90}"
        attrs = None if i % 13 == 0 else {"tvg-id": f"x{i}.tr" if i % 7 == 0 else None, "tvg-name": names[i % 9]} if i % 4 else {}
        row = (None if i % 29 == 0 else f"s{i % 3}", None if i % 17 == 0 else i % 200, names[i % 10], url, None if i % 23 == 0 else names[i * 5 % 6], attrs, 50 + i % 9)
        rows += [(*row, ["NATION_1"])] * (1 + i % 2)
    return spark.createDataFrame(rows, "source_name string, entry_id long, name string, url string, group_title string, attrs map<string,string>, source_weight int, source_tags array<string>")


def _texts(df, columns):
    return sorted(str(tuple(r)) for r in df.select(columns).collect())


def test_channels_are_chosen_on_narrow_rows(spark, monkeypatch):
    """The written selection is the selection, and no tags, maps or source
    columns of all entries pass its exchanges."""
    written = []
    real = B.materialize
    monkeypatch.setattr(B, "materialize", lambda df: written.append(df) or real(df))
    e = _repeated(spark).localCheckpoint()
    for profile in (FX.FIXTURE_PROFILE, FX.FIXTURE_PROFILE.with_(keep_per_channel=2, max_fallback_urls=3)):
        for limit in (0, 100_000):
            monkeypatch.setattr(B, "BROADCAST_ROWS", limit)
            want = B.select_entries(e, profile)
            got = B.written_selection(e, profile, lambda ids: e.join(ids, e.entry_id.eqNullSafe(ids.entry_id), "left_semi"))
            assert set(got.columns) == set(want.columns)
            # entries that tie may differ in what does not decide
            columns = ["url", "source_name", "entry_id", "score", "dedupe_key", "channel_rank", "fallback_urls", "primary_url"]
            assert want.count() > 5 and _texts(got, columns) == _texts(want, columns)
    # only the look-up reads the tags
    narrow, whole = (df._jdf.queryExecution().optimizedPlan().toString() for df in written[:2])
    assert "source_tags" in whole and "source_tags" not in narrow[:narrow.rindex("Window")]


def test_written_selection_of_the_tables(spark):
    e = FX.entries(spark, SF)
    want = B.select_entries(e, FX.FIXTURE_PROFILE)
    got = B.written_selection(e, FX.FIXTURE_PROFILE, lambda ids: FX.entries(spark, SF, ids))
    columns = [F.map_entries(c).alias(c) if c == "attrs" else F.col(c) for c in sorted(want.columns)]
    assert want.count() > 100 and _texts(got, columns) == _texts(want, columns)


def test_entries_of_given_ids(spark):
    e = FX.entries(spark, SF)
    ids = spark.createDataFrame([(r.entry_id,) for r in e.select("entry_id").limit(20).collect()] + [(None,), (-5,)], "entry_id long")
    columns = [c for c in e.columns if c != "attrs"]
    got = FX.entries(spark, SF, ids)
    assert _texts(got, columns) == _texts(e.join(ids, "entry_id", "left_semi"), columns)
    tree = got._jdf.queryExecution().optimizedPlan().toString()
    assert tree.index("Join Inner") < tree.index("Join LeftSemi") and "RepartitionByExpression" not in tree


def test_a_name_with_a_word_is_no_blank(spark):
    """``best_of_name`` takes such names for their own keys."""
    points = spark.range(0x110000).where("id < 55296 or id > 57343").select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    assert not [r.c for r in points.where(TX.has_plain_word(F.col("c"))).collect() if not TX.normalize_py(r.c)]


def test_names_are_limited_before_they_are_normalised(spark):
    rows = [(n, {"tvg-name": "--"}, f"http://u/{i}", i % 7) for i in range(200) for n in ("One", "one!", "--", None, "①", "\u2117")]
    df = spark.createDataFrame(rows, "name string, attrs map<string,string>, url string, w int").withColumn("score_dec", F.col("w").cast("decimal(12,2)"))
    limited = D.best_of_name(df, 2, 3)
    assert limited.groupBy("name").count().where("name in ('One', 'one!')").agg(F.max("count")).first()[0] == 5
    key = ["dedupe_key", "url", "channel_rank", "fallback_urls"]
    assert _texts(D.dedupe_channels(limited, 2, 3), key) == _texts(D.dedupe_channels(df, 2, 3), key)


def test_urls_of_entries_are_made_distinct_once(spark):
    tree = FX.entry_urls(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert tree.count("Aggregate [l_partkey") == 1


def test_attempts_of_a_small_selection_are_not_exchanged_for_its_urls(spark):
    selected = B.select_entries(_entries(spark), FX.FIXTURE_PROFILE).localCheckpoint()
    urls = [f"http://u{i % 4}.az/{i % 40}" for i in range(80)]
    attempts = spark.createDataFrame([(u, a, a, 200, 9, "") for u in sorted(set(urls)) for a in (1, 2)], "url string, attempt int, check_level int, status_code int, latency_ms int, error string")
    large, small = (B.health_stage(selected, attempts, FX.FIXTURE_PROFILE, small) for small in (False, True))
    assert _texts(large.checked, ["primary_url", "url", "score"]) == _texts(small.checked, ["primary_url", "url", "score"])
    tree = small.report._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in tree
