"""Classification rules, overrides, content filter, scores, dedupe, render."""

import json
from decimal import Decimal

from pyspark.sql import functions as F

from chanloom.config import DEFAULT_CATEGORIES, DEFAULT_COUNTRIES, Profile
from chanloom.operators import classify as C
from chanloom.operators import dedupe as D
from chanloom.operators import parse as P
from chanloom.operators import render as R
from chanloom.operators import score as S

ENTRY = ("source_name string, entry_id long, name string, url string, group_title string, "
         "attrs map<string,string>, source_weight int, source_tags array<string>")


def _entries(spark, rows):
    return spark.createDataFrame(rows, ENTRY)


def _row(name, url="http://x.example.com/a", group="", attrs=None, tags=None, weight=50, eid=1, src="s"):
    return (src, eid, name, url, group, attrs or {}, weight, tags or [])


def test_country_passes(spark):
    prof = Profile()
    rows = [
        _row("Movie Plus", attrs={"tvg-id": "MoviePlus"}, eid=1),          # suffix 'us' without dot -> en
        _row("AzTV", attrs={"tvg-id": "AzTV.az"}, eid=2),                  # suffix
        _row("Kanal D", attrs={"tvg-id": "X.az@SD"}, eid=3),               # locked: keywords skipped
        _row("Kanal D", eid=4),                                            # keyword -> tr
        _row("Some Ukraine News", eid=5),                                  # 'uk' substring -> en
        _row("Plain", url="http://tv.example.ru/x", eid=6),               # tld -> ru
        _row("Plain", tags=["AZ"], eid=7),                                 # source tag -> az
        _row("Plain", eid=8),                                              # other
        _row("X", attrs={"tvg-id": "X.az@SD"}, url="http://h.example.tr/1", eid=9),  # locked -> tld tr
    ]
    df = C.classify(_entries(spark, rows), prof)
    got = {r.entry_id: r.country for r in df.collect()}
    assert got == {1: "en", 2: "az", 3: "other", 4: "tr", 5: "en", 6: "ru", 7: "az", 8: "other", 9: "tr"}


def test_categories(spark):
    prof = Profile()
    rows = [_row("Eurosport HD", eid=1), _row("Disney Kids Movie", eid=2), _row("Nothing", eid=3),
            _row("Nothing", tags=["Movies"], eid=4)]
    got = {r.entry_id: r.categories for r in C.classify(_entries(spark, rows), prof).collect()}
    assert got == {1: ["sport"], 2: ["cinema", "kids"], 3: ["general"], 4: ["cinema"]}


def _overrides(spark, document):
    return C.override_tables(spark.createDataFrame([(json.dumps(document),)], "value string"))


def test_overrides_and_filter(spark):
    prof = Profile()
    rows = [_row("AzTV", eid=1), _row("cbc sport", eid=2), _row("Other", url="http://o/1", eid=3),
            _row("Hot 18+ xxx", eid=4), _row("Adult 18+", eid=5)]
    df = C.classify(_entries(spark, rows), prof)
    bn, bu = _overrides(spark, {
        "by_name": {"AzTV": {"country": "tr", "categories": ["zeta", "news"], "name": "Az TV New"},
                    "CBC Sport": {"country": "", "categories": []},
                    "Other": "not-an-object"},
        "by_url": {"http://o/1": {"country": "ru"}}})
    out = C.apply_overrides(df, bn, bu)
    got = {r.entry_id: (r.name, r.country, r.categories, r.norm_name) for r in out.collect()}
    assert got[1] == ("Az TV New", "tr", ["zeta", "news"], "az tv new")
    assert got[2][1] == "az" and got[2][2] == ["sport"]       # empty override fields keep values
    assert got[3][1] == "other"                               # name match blocks URL pass
    kept = {r.entry_id for r in C.content_filter(out, prof.unwanted_keywords).collect()}
    assert 4 not in kept and 5 in kept                        # '18+' never matches


def test_scores_are_exact(spark):
    rows = [_row("a", url="https://h/1", attrs={"tvg-id": "x", "tvg-logo": "l", "tvg-name": "n"}, weight=90)]
    df = S.pre_score(_entries(spark, rows))
    assert df.first().score_dec == Decimal("110.00")
    chk = df.withColumns({"alive": F.lit(True), "latency_ms": F.lit(1234), "check_level": F.lit(3)})
    r = S.post_score(chk).first()
    # 90 + 10 + 30 + (20 - 1.234) + 15 + 5 + 3
    assert r.score_dec == Decimal("171.77")
    z = df.withColumns({"alive": F.lit(False), "latency_ms": F.lit(0), "check_level": F.lit(0)})
    assert S.post_score(z).first().score_dec == Decimal("83.00")


def test_dedupe_invariants(spark):
    rows = []
    for i in range(40):
        rows.append(_row(f"Chan {i % 5}", url=f"http://h/{i % 23}", weight=50 + i % 7, eid=i, src=f"s{i % 3}"))
    df = S.pre_score(_entries(spark, rows))
    for keep, n in [(1, 4), (2, 3), (1, 0)]:
        sel = D.dedupe_channels(D.with_dedupe_key(D.dedupe_url(df)), keep, n).collect()
        urls = [r.url for r in sel]
        assert len(urls) == len(set(urls))
        by_key = {}
        for r in sel:
            by_key.setdefault(r.dedupe_key, []).append(r)
        for key, winners in by_key.items():
            assert len(winners) <= keep
            fb = winners[0].fallback_urls
            assert len(fb) <= n
            assert not set(fb) & {w.url for w in winners}
            assert all(w.fallback_urls == fb for w in winners)


def test_render_roundtrip(spark):
    rows = [_row("Chan A", url="http://a/1", group="News", attrs={"tvg-id": "a.az", "tvg-name": " "}),
            _row("Chan B", url="http://a/2", attrs={"z": "1", "group-title": "G"}, eid=2)]
    df = R.render_rows(_entries(spark, rows)).collect()
    lines = {r.url: r.extinf for r in df}
    assert lines["http://a/1"] == '#EXTINF:-1 group-title="News" tvg-id="a.az" tvg-name="Chan A",Chan A'
    assert lines["http://a/2"] == '#EXTINF:-1 group-title="G" tvg-name="Chan B" z="1",Chan B'
    text = [(i * 2, r.extinf) for i, r in enumerate(df)] + [(i * 2 + 1, r.url) for i, r in enumerate(df)]
    back = P.m3u_parse(spark.createDataFrame([("s", n, l) for n, l in text],
                                             "source_name string, line_no long, line string")).collect()
    assert sorted((r.name, r.url) for r in back) == [("Chan A", "http://a/1"), ("Chan B", "http://a/2")]


def test_default_rules_compile(spark):
    prof = Profile(countries=DEFAULT_COUNTRIES, categories=DEFAULT_CATEGORIES)
    df = C.classify(_entries(spark, [_row("İdman TV"), _row("Россия 1", eid=2)]), prof)
    got = {r.entry_id: r.country for r in df.collect()}
    assert got == {1: "other", 2: "ru"}
