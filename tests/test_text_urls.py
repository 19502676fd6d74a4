"""Text and URL functions against their Python definitions."""

import random
from urllib.parse import urljoin, urlparse

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chanloom.functions import payload as PL
from chanloom.functions import text as TX
from chanloom.functions import urls as U

TRICKY = ["İdman TV", "Ａｂｃ  HD", "straße", "kids-tv x", "Foo_bar.+-", "", "abc1def", "o'neil",
          "  Hello World  ", "ﬁ ligature", "Ǆemal", "CBC Sport [Geo-blocked]", "18+ Zone",
          "Кино ТВ", "ÇOCUK", "x́y", "١٢٣ news", "tab\there"]


def test_normalize_matches_python(spark):
    df = spark.createDataFrame([(v,) for v in TRICKY] + [(None,)], "s string")
    for r in df.select("s", TX.normalize_text("s").alias("n")).collect():
        assert r.n == TX.normalize_py(r.s), r.s


def test_normalize_builtin_path_is_exact_for_ascii(spark):
    vals = ["Hello, World!", "a__b--c", "  x  ", "CNN International (720p) [Geo-blocked]"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    for r in df.select("s", TX.normalize_text("s").alias("n")).collect():
        assert r.n == TX.normalize_py(r.s)


def test_normalize_array(spark):
    df = spark.createDataFrame([(["AZ", "Спорт", "en_US"],), (["x"],), (None,)], "a array<string>")
    got = [r.n for r in df.select(TX.normalize_array("a").alias("n")).collect()]
    assert got == [["az", "спорт", "en_us"], ["x"], []]


def test_title_case_and_strip(spark):
    df = spark.createDataFrame([(v,) for v in TRICKY], "s string")
    # Ligatures and digraphs with their own title-case form (U+FB01, U+01C4)
    # become upper case in Spark; titles are only applied to rule ids.
    special = {"ﬁ ligature", "Ǆemal"}
    for r in df.select("s", TX.title_case("s").alias("t"), TX.py_strip("s").alias("p")).collect():
        if r.s not in special:
            assert r.t == r.s.title(), r.s
        assert r.p == r.s.strip()


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="ab \r\n\x0b\x0c\x1c\x85  \t", max_size=12), min_size=1, max_size=8))
def test_split_lines_matches_splitlines(spark, parts):
    text = "".join(parts)
    got = spark.range(1).select(TX.split_lines(F.lit(text)).alias("x")).first().x
    expected = text.splitlines()
    # Spark keeps a trailing empty piece that splitlines drops; blanks are
    # removed by every caller.
    assert [x for x in got if x.strip()] == [x for x in expected if x.strip()]


URLS = ["http://user:pw@Host.Example.AZ:8080/x", "https://[::1]:80/a", "rtmp://x.y/z", "//net.loc/p",
        "HTTP://A.b", "http://ho st|x_y/a", "no-scheme/path", "  http://x.tr", "mailto:x@y", "1http://a",
        "https://cdn.example.az/live/1.m3u8?x=1#f", "http://a.b:99", "ftp://[2001:db8::1]/x"]


def test_scheme_and_host_match_urlparse(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "u string")
    for r in df.select("u", U.url_scheme("u").alias("s"), U.url_host("u").alias("h")).collect():
        p = urlparse(r.u)
        assert r.s == p.scheme.lower(), r.u
        assert r.h == (p.hostname or "").lower(), r.u


def test_malformed_url_does_not_raise(spark):
    df = spark.createDataFrame([("http://[abc",)], "u string")
    r = df.select(U.url_host("u").alias("h"), U.url_scheme("u").alias("s")).first()
    assert r.s == "http"


BASES = ["http://a/b/c/d;p?q", "https://x.example.org/live/1.m3u8", "http://h", "HTTP://H:80/a//b/./c/../d", "",
         "rtmp://x/y/z", "/rel/path", "http://a/b/c/;x", "http://a/b?q=/../z", "mailto:foo", "http://a/.."]
BITS = ["..", ".", "a", "b;x", "c?d=e/../f", "g#h", "//n", "/", "/x/y", ";z", "?q", "#f", "http:g", "https://o/p?x;y", "x;", "a:b",
        " g", "g\th", "...", "..;a"]


def test_resolve_matches_urljoin(spark):
    rnd = random.Random(4)
    refs = set(BITS) | {sep.join(rnd.choices(BITS, k=rnd.randint(2, 4))) for sep in "/." for _ in range(300)}
    refs |= {"".join(rnd.choices(BITS, k=rnd.randint(2, 4))) for _ in range(200)}
    df = spark.createDataFrame([(b, r) for b in BASES for r in refs], "b string, r string")
    for r in df.select("b", "r", U.url_resolve("b", "r").alias("x")).collect():
        try:
            want = urljoin(r.b, r.r) if r.r else None
        except ValueError:
            continue
        assert r.x == want, (r.b, r.r)


def test_payload_predicates(spark):
    rows = [("text/html", b"<p>Access Denied</p>", True), ("video/mp2t", b"<HTML>forbidden", True),
            ("video/mp2t", b"forbidden", False), ("text/html", b"ok", False),
            ("text/html", b"\xff\xfe geo restricted", True)]
    df = spark.createDataFrame(rows, "ct string, body binary, exp boolean")
    for r in df.select("exp", PL.denied_payload(F.col("ct"), F.col("body")).alias("d")).collect():
        assert r.d == r.exp
    pl = spark.createDataFrame([("application/x-mpegURL", b""), ("text/plain", b"#EXTM3U\n"),
                                ("text/plain", b"#extm3u")], "ct string, body binary")
    got = [r.p for r in pl.select(PL.is_playlist(F.col("ct"), F.col("body")).alias("p")).collect()]
    assert got == [True, True, False]


def test_first_media_uri(spark):
    texts = ["#EXTM3U\n  \n#x\n  seg.ts  \nb", "#EXTM3U", "", "a\r\nb"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.m for r in df.select(PL.first_media_uri(F.col("t")).alias("m")).collect()]
    assert got == ["seg.ts", "", "", "a"]


def test_is_http_matches_urlparse(spark):
    urls = URLS + ["\t https://x/", "ht\ttps://x", "HTTPS:x", "httpx://a", "", "xhttp://a", "\x01http://a"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    for r in df.select("u", U.is_http_url("u").alias("h")).collect():
        assert r.h == (urlparse(r.u).scheme.lower() in ("http", "https")), repr(r.u)


def test_host_fast_path_cases(spark):
    urls = ["http://a@b@c.example/x", "http://a@b/x@y", "http://h:8@x/", "https://[v1.x]:9/", "//a@b:1",
            "http://\\tx.y/", "http://x.y\\n/", "  http://[::1", "http://h?x@y", "http:///p", "mailto:a@b"]
    urls = [u.replace("\\\\t", "\t").replace("\\\\n", "\n") for u in urls]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    for r in df.select("u", U.url_host("u").alias("h")).collect():
        try:
            exp = (urlparse(r.u).hostname or "").lower()
        except ValueError:
            continue
        assert r.h == exp, repr(r.u)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="a#b \t\r\n\x0b\x0c\x1c\x1f\x85\xa0 　", max_size=10),
                min_size=1, max_size=6))
def test_first_media_uri_is_the_first_stripped_line(spark, parts):
    texts = ["".join(parts), "#EXTM3U\r\n  \r\n#x\r\n  seg.ts  \r\nb", "\n\n  a b  \n", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", PL.first_media_uri(F.col("t")).alias("m")).collect():
        assert r.m == next((x for x in map(str.strip, r.t.splitlines()) if x and x[0] != "#"), ""), repr(r.t)


def test_safe_characters_need_no_udf(spark):
    safe = [chr(c) for c in range(0x530) if TX._safe(chr(c))]
    rnd = random.Random(9)
    vals = ["".join(rnd.choices(safe, k=12)) for _ in range(400)]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    builtin = F.trim(F.regexp_replace(F.lower("s"), TX._NON_WORD_RE, " "))
    for r in df.select("s", builtin.alias("n"), F.col("s").rlike(f"^{TX.SAFE_CLASS}*$").alias("safe")).collect():
        assert r.safe and r.n == TX.normalize_py(r.s), repr(r.s)
