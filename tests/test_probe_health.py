"""Probe levels, best attempt, fallback swap and report application."""

import itertools

import pytest
from pyspark.sql import functions as F

from chanloom.operators import health as H
from chanloom.operators import probe as PR

SAMPLE_SCHEMA = ("url string, attempt int, status int, content_type string, body binary, "
                 "error string, elapsed_ms int")
PL = "application/vnd.apple.mpegurl"


def _levels(spark, rows, targets):
    s = spark.createDataFrame(rows, SAMPLE_SCHEMA)
    t = spark.createDataFrame([(u,) for u in targets], "url string")
    return {r.url: (r.check_level, r.status_code, r.error, r.latency_ms)
            for r in PR.probe_levels(s, t).collect()}


def test_decision_table(spark):
    rows = [
        ("http://a/0", 1, 404, "text/plain", b"", "", 5),                        # entry failed
        ("http://a/1", 1, 200, "text/html", b"<b>Access Denied</b>", "", 5),      # denied
        ("http://a/2", 1, 200, "video/mp2t", b"data", "", 5),                     # stream
        ("http://a/3", 1, 200, PL, b"#EXTM3U\n#X", "", 5),                        # empty playlist
        ("http://a/4", 1, 200, PL, b"#EXTM3U\nrtmp://x/y", "", 5),                # child scheme
        ("http://a/5", 1, 200, PL, b"#EXTM3U\n/c5.m3u8", "", 5),
        ("http://a/c5.m3u8", 1, 403, PL, b"", "", 7),                             # child failed
        ("http://a/6", 1, 200, PL, b"#EXTM3U\n/c6.m3u8", "", 5),
        ("http://a/c6.m3u8", 1, 206, "video/mp2t", b"data", "", 7),               # child stream -> 3
        ("http://a/7", 1, 200, PL, b"#EXTM3U\n/c7.m3u8", "", 5),
        ("http://a/c7.m3u8", 1, 200, PL, b"#EXTM3U", "", 7),                      # child empty -> 2
        ("http://a/8", 1, 200, PL, b"#EXTM3U\n/c8.m3u8", "", 5),
        ("http://a/c8.m3u8", 1, 200, PL, b"#EXTM3U\ns8.ts", "", 7),
        ("http://a/s8.ts", 1, 200, "video/mp2t", b"data", "", 9),                 # segment ok -> 3
        ("http://a/9", 1, 200, PL, b"#EXTM3U\n/c9.m3u8", "", 5),
        ("http://a/c9.m3u8", 1, 200, PL, b"#EXTM3U\ns9.ts", "", 7),
        ("http://a/s9.ts", 1, 500, "video/mp2t", b"", "HTTP Error 500", 9),       # segment failed
        ("http://a/10", 1, 200, PL, b"#EXTM3U\n/c10.m3u8", "", 5),
        ("http://a/c10.m3u8", 1, 200, PL, b"#EXTM3U\ns10.ts", "", 7),
        ("http://a/s10.ts", 1, 200, "video/mp2t", b"<html>blocked</html>", "", 9),  # segment denied
        ("http://a/11", 1, 200, PL, b"#EXTM3U\n/missing.m3u8", "", 5),           # child not captured
        ("http://a/12", 1, None, "", b"", "timed out", 5),                       # no status
        ("http://a/13", 1, 200, PL, b"#EXTM3U\n/c13.m3u8", "", 5),
        ("http://a/c13.m3u8", 1, 200, PL, b"#EXTM3U\nftp://s/x.ts", "", 7),       # segment scheme
    ]
    targets = [f"http://a/{i}" for i in range(14)] + ["rtmp://a/x"]
    got = _levels(spark, rows, targets)
    assert got["http://a/0"] == (0, 404, "entry:404", 5)
    assert got["http://a/1"][:3] == (0, 200, "entry:denied_payload")
    assert got["http://a/2"][:3] == (1, 200, "")
    assert got["http://a/3"][:3] == (1, 200, "empty_playlist_but_connects")
    assert got["http://a/4"][:3] == (1, 200, "child_unsupported_scheme")
    assert got["http://a/5"] == (1, 200, "child:403", 12)
    assert got["http://a/6"] == (3, 206, "", 12)
    assert got["http://a/7"][:3] == (2, 200, "")
    assert got["http://a/8"] == (3, 200, "", 21)
    assert got["http://a/9"][:3] == (2, 200, "segment:HTTP Error 500")
    assert got["http://a/10"][:3] == (2, 200, "segment:denied_payload")
    assert got["http://a/11"][:3] == (1, 200, "child:not_captured")
    assert got["http://a/12"][:3] == (0, None, "entry:timed out")
    assert got["http://a/13"][:3] == (2, 200, "segment_unsupported_scheme")
    assert "rtmp://a/x" not in got  # no sample captured for it


def test_unsupported_scheme(spark):
    got = _levels(spark, [("rtmp://a/x", 1, 200, PL, b"", "", 3)], ["rtmp://a/x"])
    assert got["rtmp://a/x"] == (0, None, "unsupported_scheme", 0)


def _expected(levels):
    """The first strict attempt, else the first that connects, else none."""
    order = [i for wanted in ({2, 3}, {1}) for i, lv in enumerate(levels) if lv in wanted]
    return (levels[order[0]], 200 + order[0], 10 * (order[0] + 1), f"e{order[0]}") if order else (0, None, None, "unknown")


@pytest.mark.parametrize("retries", [1, 2, 3])
def test_best_attempt_of_every_sequence(spark, retries):
    seqs = [s for n in range(1, 4) for s in itertools.product(range(4), repeat=n)]
    rows = [(f"u{j}", i + 1, lv, 200 + i, 10 * (i + 1), f"e{i}")
            for j, seq in enumerate(seqs) for i, lv in enumerate(seq)]
    df = spark.createDataFrame(rows, "url string, attempt int, check_level int, status_code int, "
                                     "latency_ms int, error string")
    got = {r.url: (r.check_level, r.status_code, r.latency_ms, r.error)
           for r in H.best_attempt(df, retries).collect()}
    assert got == {f"u{j}": _expected(seq[:retries]) for j, seq in enumerate(seqs)}


def test_media_line_after_long_comments(spark):
    body = b"#EXTM3U\n" + b"# padding\n" * 2000 + b"/c.m3u8\n"
    rows = [("http://a/1", 1, 200, PL, body, "", 5), ("http://a/c.m3u8", 1, 200, "video/mp2t", b"x", "", 7)]
    assert _levels(spark, rows, ["http://a/1"])["http://a/1"] == (3, 200, "", 12)


def test_second_attempt_follows_its_own_samples(spark):
    rows = [("http://a/1", 1, None, "", None, "timed out", 5), ("http://a/1", 2, 200, PL, b"#EXTM3U\nc", "", 6),
            ("http://a/c", 1, 200, "video/mp2t", b"x", "", 7), ("http://a/c", 2, 410, "", b"", "", None)]
    s = spark.createDataFrame(rows, SAMPLE_SCHEMA)
    got = {r.attempt: (r.check_level, r.status_code, r.error, r.latency_ms)
           for r in PR.probe_levels(s, s.select("url").where("url like '%1'")).collect()}
    assert got == {1: (0, None, "entry:timed out", 5), 2: (1, 200, "child:410", 6)}


def test_no_body_is_shuffled(spark):
    s = spark.createDataFrame([("http://a/1", 1, 200, PL, b"", "", 5)], SAMPLE_SCHEMA)
    facts = PR.sample_facts(s)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in facts and "Python" not in facts  # reduced where they are scanned
    plan = PR.probe_levels(s, s.select("url"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    assert not any("body" in line for line in plan.splitlines() if "Exchange" in line)


def test_hot_child(spark):
    """A child that a third of all entries share is dealt over tasks without
    the adaptive skew join; levels are those of the plain join."""
    rows = [(f"http://a/x/{i}", 1, 200, PL, b"#EXTM3U\n/hot.m3u8" if i % 3 == 0 else f"#EXTM3U\n/c{i}.m3u8".encode(), "", 5) for i in range(900)]
    rows += [("http://a/hot.m3u8", 1, 200, PL, b"#EXTM3U\n/seg.ts", "", 7), ("http://a/seg.ts", 1, 200, "video/mp2t", b"x", "", 3)]
    rows += [(f"http://a/c{i}.m3u8", 1, 404 if i % 2 else 200, "video/mp2t", b"x", "", 9) for i in range(900) if i % 3 == 1]
    s = spark.createDataFrame(rows, SAMPLE_SCHEMA)
    targets = s.where("url like '%/x/%'").select("url")
    plain = {tuple(r) for r in PR.probe_levels(s, targets).collect()}
    settings = {"spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = PR.probe_levels(s, targets, task_rows=20)
        at = [(tuple(r)[:-1], r.part) for r in out.withColumn("part", F.spark_partition_id()).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r for r, _ in at} == plain and len(at) == 900
    hot = [part for (url, *_), part in at if int(url.rsplit("/", 1)[1]) % 3 == 0]
    assert len(hot) == 300 and max(hot.count(p) for p in set(hot)) < 200


def _selected(spark, rows):
    return spark.createDataFrame(rows, "primary_url string, url string, fallback_urls array<string>")


def test_fallback_swap_first_live_in_order(spark):
    sel = _selected(spark, [("p1", "p1", ["f1", "f2", "f3", "f4"]),
                            ("p2", "p2", ["g1"]), ("p3", "p3", ["h1"]), ("p4", "p4", ["f4"])])
    rep = spark.createDataFrame([("p1", 0), ("f1", 0), ("f2", 2), ("f3", 1), ("f4", 3), ("p2", 1),
                                 ("g1", 3), ("p3", 0), ("h1", 0), ("p4", 0)],
                                "url string, check_level int")
    got = {r.primary_url: r.url for r in H.fallback_swap(sel, rep, 3).collect()}
    assert got == {"p1": "f2", "p2": "p2", "p3": "p3", "p4": "f4"}
    # only the first max_fallbacks are tried
    got1 = {r.primary_url: r.url for r in H.fallback_swap(sel, rep, 1).collect()}
    assert got1["p1"] == "p1"


def test_fallback_candidates(spark):
    sel = _selected(spark, [("p1", "p1", ["f1", "f2", "f3", "f4"]), ("p2", "p2", ["f1", "g1"])])
    rep = spark.createDataFrame([("p1", 0), ("p2", 0)], "url string, check_level int")
    got = sorted(r.url for r in H.fallback_candidates(sel, rep, 3).collect())
    assert got == ["f1", "f2", "f3", "g1"]


def test_apply_health_missing_report(spark):
    e = spark.createDataFrame([("a",), ("b",)], "url string")
    rep = spark.createDataFrame([("a", 2, True, 200, 15, "")], H.REPORT_SCHEMA)
    got = {r.url: (r.alive, r.check_level, r.check_error, r.latency_ms)
           for r in H.apply_health(e, rep).collect()}
    assert got == {"a": (True, 2, "", 15), "b": (False, 0, "not_checked", None)}


def test_settle_equals_swap_then_apply(spark):
    sel = _selected(spark, [("p1", "p1", ["f1", "f2", "f3", "f4"]), ("p2", "p2", ["g1"]), ("p3", "p3", ["h1"]),
                            ("p4", "p4", ["f4"]), ("p5", "p5", []), ("p6", "p6", ["x", "f2"])])
    rep = spark.createDataFrame([(u, lv, lv > 0, 200 if lv else None, lv, "e" if not lv else "") for u, lv in
                                 [("p1", 0), ("f1", 0), ("f2", 2), ("f3", 1), ("f4", 3), ("p2", 1), ("g1", 3), ("p3", 0), ("h1", 0), ("p4", 0), ("p5", 0)]],
                                H.REPORT_SCHEMA)
    for n in (0, 1, 3):
        want = H.apply_health(H.fallback_swap(sel, rep, n), rep)
        got = H.settle(sel, rep, n).select(*want.columns)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_candidates_of_a_checked_build(spark):
    from chanloom.config import Profile
    from chanloom.plans import build as B

    sel = spark.createDataFrame([("p1", "p1", ["f1", "f2"], 50), ("p2", "p2", ["f1"], 50)],
                                "primary_url string, url string, fallback_urls array<string>, source_weight int")
    sel = sel.selectExpr("*", "map('tvg-id', '') as attrs", "'n' as name")
    att = spark.createDataFrame([("p1", 1, 0), ("p2", 1, 2), ("f1", 1, 0), ("f2", 1, 1)], "url string, attempt int, check_level int")
    att = att.selectExpr("*", "200 as status_code", "5 as latency_ms", "'' as error")
    ck = B.health_stage(sel, att, Profile())
    assert sorted(r.url for r in ck.candidates.collect()) == ["f1", "f2"]
    assert {r.primary_url: r.url for r in ck.checked.collect()} == {"p1": "f2", "p2": "p2"}


def test_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from chanloom.session import ensure_checkpoint_dir

    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    spark = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(spark)
