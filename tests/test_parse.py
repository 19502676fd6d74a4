"""Playlist parsing: hand-written rows, and equal results for every chunk size."""

import random

import pytest
from pyspark.sql import functions as F

from chanloom.operators import parse as P


VOCAB = ['#EXTINF:-1 tvg-id="a.az" group-title="News",Chan A', '#EXTINF:-1,Plain', '#EXTINF:abc,bad',
         '#EXTINF:0 group-title="",Empty Group', '#EXTINF:-1 a="1" a="2" __name__="x",Dup',
         '#EXTGRP:Sports', '#EXTGRP:', '#EXTVLCOPT:x', 'http://u/1', 'https://u/2', '  ', '#EXTM3U',
         'rtmp://u/3', '#EXTINF:5 tvg-name=" T ",Spaced , name']


def _run(spark, sources, chunk):
    rows = [(s, no, line) for s, lines in sources.items() for no, line in lines]
    df = spark.createDataFrame(rows, "source_name string, line_no long, line string")
    got = P.m3u_parse(df, chunk_lines=chunk).collect()
    return {s: sorted((r.entry_id, r.name, r.url, r.group_title, tuple(sorted(r.attrs.items())))
                      for r in got if r.source_name == s) for s in sources}


#: (line, what its entry is: name, url, group, attributes)
SCRIPT = [
    ("#EXTM3U", None),
    ("http://before/any", None),
    ('#EXTINF:-1 tvg-id="a.az" group-title="News",Chan A', None),
    ("#EXTVLCOPT:x", None),
    ("  http://u/1  ", ("Chan A", "http://u/1", "News", {"tvg-id": "a.az", "group-title": "News"})),
    ("http://u/no-header", None),
    ("#EXTGRP: Sports ", None),
    ("#EXTINF:-1,First", None),
    ("#EXTINF:7,Plain , name ", None),
    ("   ", None),
    ("rtmp://u/2", ("Plain , name", "rtmp://u/2", "Sports", {})),
    ("#EXTINF:-1,Ungrouped", None),
    ("http://u/3", ("Ungrouped", "http://u/3", "", {})),
    ("#EXTGRP:Kept", None),
    ("#EXTINF:abc,bad", None),
    ("http://u/bad", None),
    ('#EXTINF:0 a="1" a=" 2 " __name__="x",Dup', None),
    ("http://u/4", ("Dup", "http://u/4", "Kept", {"a": "2"})),
    ('#EXTINF:0 group-title="",Empty Group', None),
    ("#EXTGRP:Ignored", None),
    ("http://u/5", ("Empty Group", "http://u/5", "", {"group-title": ""})),
    ("#EXTINF:-1,Last", None),
]


@pytest.mark.parametrize("chunk", [1, 3, 7, 1 << 20])
def test_script(spark, chunk):
    got = _run(spark, {"s": [(i, line) for i, (line, _) in enumerate(SCRIPT)]}, chunk)["s"]
    want = [(i, name, url, group, tuple(sorted(attrs.items()))) for i, (_, entry) in enumerate(SCRIPT) if entry for name, url, group, attrs in [entry]]
    assert got == want


@pytest.mark.parametrize("chunk", [1, 3, 7])
def test_chunks_do_not_matter(spark, chunk):
    rnd = random.Random(chunk)
    sources = {}
    for s in range(6):
        nos = sorted(rnd.sample(range(0, 400), rnd.randint(0, 60)))
        sources[f"src{s}"] = [(no, rnd.choice(VOCAB)) for no in nos]
    assert _run(spark, sources, chunk) == _run(spark, sources, 1 << 20)


def test_group_rules(spark):
    lines = [(0, "#EXTGRP:G1"), (1, '#EXTINF:-1 group-title="",X'), (2, "http://a"),
             (3, "#EXTGRP:G2"), (4, "#EXTINF:bad"), (5, "http://b"), (6, "#EXTINF:-1,Y"),
             (7, "#EXTINF:-1,Z"), (8, "http://c"), (9, "http://d")]
    got = _run(spark, {"s": lines}, 2)["s"]
    assert [(g[0], g[1], g[3]) for g in got] == [(2, "X", ""), (8, "Z", "G2")]


def test_extinf_attrs_last_wins(spark):
    df = spark.createDataFrame([('a="1" b="x" a=" 2 " __name__="n"',)], "b string")
    m = df.select(P.extinf_attrs(F.col("b")).alias("m")).first().m
    assert m == {"a": "2", "b": "x"}


def test_text_lines(spark):
    df = spark.createDataFrame([(1, "a\r\n\n  b   c")], "id int, text string")
    got = [(r.line_no, r.line) for r in P.text_lines(df, "text", ("id",)).collect()]
    assert got == [(0, "a"), (2, "b"), (3, "c")]


def test_extinf_attrs_without_last_win_policy(spark):
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "EXCEPTION")
    try:
        df = spark.createDataFrame([('a="1" b="x" a=" 2 " __name__="n"',)], "b string")
        m = df.select(P.extinf_attrs(F.col("b")).alias("m")).first().m
    finally:
        spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    assert m == {"a": "2", "b": "x"}
