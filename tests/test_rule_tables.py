"""Rule tables: equal to the compiled rules, large, skewed, no nested loops."""

import random

import pytest
from pyspark.sql import functions as F

from chanloom.config import DEFAULT_CATEGORIES, DEFAULT_COUNTRIES, Profile
from chanloom.operators import classify as C
from chanloom.operators import rule_tables as RT
from chanloom.operators import skew
from chanloom.sources import fixtures as FX

SF = "/root/testdata/sf0.001"
ENTRY = ("source_name string, entry_id long, name string, url string, group_title string, "
         "attrs map<string,string>, source_weight int, source_tags array<string>")


def entries(spark, n=600, seed=1):
    random.seed(seed)
    words = ["AzTV", "CBC", "sport", "uk", "TRT", "Новости", "перв", "Kids", "HBO", "xxx", "18+", "ITV.az", "мədəniyyət", "ﬁlm", "Straße", "", " ", "é", "kanal d", "a"]
    ids = ["", "AzTV.az", "a.TR", "b.uk@SD", "x.az.org", ".az", "ru", "---", "q.us"]
    hosts = ["x.az", "cdn.example.tr", "h.ru", "h.co.uk", "h.com", "", "az", "HOST.AZ"]
    tags = [[], ["az"], ["Movies", "eng"], ["sport", ""], ["EN", "tr"], None]
    rows = [("s", i, " ".join(random.choices(words, k=random.randint(0, 4))), f"http://{random.choice(hosts)}/{i % 50}", random.choice(words + [None]),
             {"tvg-id": random.choice(ids), "tvg-name": random.choice(words)} if i % 5 else {}, 50, random.choice(tags)) for i in range(n)]
    return spark.createDataFrame(rows, ENTRY)


RULES = [
    (DEFAULT_COUNTRIES, DEFAULT_CATEGORIES),
    # a suffix of two countries, blank texts, one text in several rules, rules without texts, single characters
    ([{"id": "one", "tvg_id_suffixes": [".az", "az"], "keywords": ["a", "kanal"], "source_tags": [""]}, {"id": "two", "tvg_id_suffixes": [".az", "--"], "keywords": ["a", ""], "tlds": [".uk", "com"]},
      {"id": "one", "keywords": ["trt"], "tlds": ["uk"]}, {"title": "no id", "keywords": ["hbo"]}],
     [{"id": "z", "keywords": ["a", "tv"], "source_tags": ["az", ""]}, {"id": "b", "keywords": ["a", "!!"]}, {"id": "z", "keywords": ["новости"]}]),
    ([], []),
]


@pytest.mark.parametrize("which, task_rows", [(0, RT.TASK_ROWS), (1, 60), (2, RT.TASK_ROWS)])
def test_tables_equal_compiled_rules(spark, which, task_rows):
    countries, categories = RULES[which]
    df = entries(spark)
    want = {r.entry_id: (r.country, r.categories) for r in C.classify(df, Profile(countries=countries, categories=categories)).collect()}
    got = RT.classify_by_tables(df, RT.rule_table(spark, countries, "other"), RT.rule_table(spark, categories, "general"), task_rows)
    rows = got.collect()
    assert len(rows) == len(want) and {r.entry_id: (r.country, r.categories) for r in rows} == want


@pytest.mark.parametrize("keywords", [["a", "kanal d", "Ü", "18+"], [""], []])
def test_content_filter(spark, keywords):
    df = C.with_normalized(entries(spark))
    want = sorted(r.entry_id for r in C.content_filter(df, keywords).collect())
    got = RT.content_filter_by_table(df, RT.keyword_table(spark, keywords), 60)
    assert sorted(r.entry_id for r in got.collect()) == want


def test_hundred_thousand_rules(spark):
    """More keywords than a compiled expression could hold, against Python."""
    random.seed(3)
    letters = "abcdefghij"
    keywords = ["".join(random.choices(letters, k=random.randint(3, 7))) for _ in range(100_000)]
    texts = [" ".join("".join(random.choices(letters, k=random.randint(1, 9))) for _ in range(3)) for _ in range(400)]
    place = {}
    for i, k in enumerate(keywords):
        place.setdefault(k, i)
    want = {}
    for t in set(texts):
        best = min((place[t[a:b]] for a in range(len(t)) for b in range(a + 3, a + 8) if t[a:b] in place), default=None)
        if best is not None:
            want[t] = best
    rules = spark.createDataFrame([("keyword", i, k, f"r{i}") for i, k in enumerate(keywords)], RT.SCHEMA)
    values = spark.createDataFrame([(t,) for t in set(texts)], "value string")
    pairs = RT.matching(values, RT._leading(RT._patterns(RT.normalized_rules(rules), "keyword")), task_rows=50)
    assert {r.value: r.best.p for r in RT._first(pairs, "best").collect()} == want


def test_plan_has_no_nested_loop(spark):
    rules = FX.rule_tables(spark, SF)
    df = C.with_normalized(FX.entries(spark, SF))
    for out in (RT.classify_by_tables(df, rules["countries"], rules["categories"]), RT.content_filter_by_table(df, rules["unwanted"])):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_salted_left_join(spark):
    """A key of a third of all rows: the same rows as the plain join, dealt
    over many tasks without the adaptive skew join."""
    left = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 700).cast("string"))).alias("key"), "id")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k4", 3), ("none", 4)], "key string, v int")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.skewJoin.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew.salted_left_join(left, right, ["key"], [F.col("id")], task_rows=100)
        sizes = [r.n for r in joined.where("key = 'hot'").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        got = sorted(map(tuple, joined.select("id", "key", "v").collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == sorted(map(tuple, left.join(right, "key", "left").select("id", "key", "v").collect()))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(sizes) == 10_000 and len(sizes) == parts and max(sizes) < 10_000 * 0.6


def _channels(spark, n, seed):
    """Entries of few words, so that keywords lie across their fields, and a
    channel under many hosts."""
    random.seed(seed)
    words = ["a", "ab", "b", "tv", "7", "Ünal", "x.y"]

    def text(most):
        return " ".join(random.choices(words, k=random.randint(0, most)))

    rows = [("s", i, text(3), f"http://{random.choice(['a.b', 'tv', 'ab.tv.a', 'h7.az'])}/{i % 9}", random.choice([text(2), None]),
             {"tvg-id": text(2), "tvg-name": text(1)} if i % 5 else {}, 50, random.choice([None, [], ["t"], ["T", "u"]])) for i in range(n)]
    return spark.createDataFrame(rows, ENTRY)


@pytest.mark.parametrize("task_rows, small_rows", [(RT.TASK_ROWS, RT.SMALL_ROWS), (20, 0)])
def test_keywords_across_fields(spark, monkeypatch, task_rows, small_rows):
    """Keywords of one to six words, which begin and end anywhere in the five
    fields; salted and unsalted, looked up with and without a broadcast."""
    monkeypatch.setattr(RT, "SMALL_ROWS", small_rows)
    df = _channels(spark, 400, 5)
    words = ["a", "b", "ab", "tv", "7", "ünal", "y", "x"]
    keywords = list(dict.fromkeys(" ".join(random.choices(words, k=random.choice([1, 2, 2, 3, 3, 4, 5, 6]))) for _ in range(260)))
    random.shuffle(keywords)
    countries = [{"id": f"r{i}", "keywords": [k]} for i, k in enumerate(k for k in keywords if len(k) > 3)] + [{"id": "t", "source_tags": ["t"], "tlds": [".az"], "tvg_id_suffixes": ["b 7"]}]
    want = {r.entry_id: r.country for r in C.classify(df, Profile(countries=countries, categories=[])).collect()}
    rows = RT.country_by_tables(C.with_normalized(df), RT.rule_table(spark, countries, "other"), task_rows).collect()
    assert len(rows) == len(want) and {r.entry_id: r.country for r in rows} == want
    assert len(set(want.values())) > 30


def test_keywords_over_three_and_more_fields(spark):
    """Spans of two to five fields, some ending in the host; a blank field in
    between breaks them.  Every keyword has letters and entries of its own."""
    fields = [("one", "two", "three", "four", "five.x"), ("none", "two", "three", "fourth", "five.y"), ("one", "", "three", "four", "six.x"), ("one", "two", "thre", "four", "five.x")]
    keywords = ["one two three four five", "ne two three fo", "e three", "e two thre four", "three four six", "four five x", "one three", "two three fourth five y", "o three", "one two three four five xx"]

    def own(text, k):
        return "".join(chr(0x4E00 + 32 * k + ord(c) - 97) if c.isalpha() else c for c in text)

    rows = [("s", 10 * k + i, own(n, k), f"http://{own(h, k)}/{i}", own(g, k), {"tvg-name": own(t, k), "tvg-id": own(d, k)}, 50, None)
            for k in range(len(keywords)) for i, (n, g, t, d, h) in enumerate(fields)]
    rules = spark.createDataFrame([("keyword", k, own(keyword, k), f"r{k}") for k, keyword in enumerate(keywords)], RT.SCHEMA)
    got = RT.country_by_tables(C.with_normalized(spark.createDataFrame(rows, ENTRY)), rules).collect()
    texts = [" ".join([*f[:4], f[4].replace(".", " ")]) for f in fields]
    assert {r.entry_id: r.country for r in got} == {10 * k + i: f"r{k}" if keyword in text else "other" for k, keyword in enumerate(keywords) for i, text in enumerate(texts)}
    assert sum(r.country != "other" for r in got) == sum(keyword in text for keyword in keywords for text in texts)


def test_one_number_for_two_channels(spark, monkeypatch):
    """Channels whose numbers are equal get other numbers."""
    xxhash64, asked = F.xxhash64, []

    def weak(*columns):
        if len(columns) == 1 + len(RT.TEXT_FIELDS):
            asked.append(columns)
            if len(asked) == 1:
                return xxhash64(F.lit(0))
        return xxhash64(*columns)

    monkeypatch.setattr(RT.F, "xxhash64", weak)
    df = C.with_normalized(_channels(spark, 60, 6))
    countries = [{"id": "k", "keywords": ["tv a"]}, {"id": "i", "tvg_id_suffixes": ["7"]}]
    want = {r.entry_id: r.country for r in C.classify(df, Profile(countries=countries, categories=[])).collect()}
    assert {r.entry_id: r.country for r in RT.country_by_tables(df, RT.rule_table(spark, countries, "other")).collect()} == want
    assert len(asked) > 1
