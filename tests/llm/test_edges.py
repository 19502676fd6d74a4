"""Nulls, empty and long texts, ties, repeats, empty tables, clashing names."""

import pytest

import corpus_pipeline
from chanloom.llm import cuckoo, jaccard_join, mixing, packing, pii, prefix_tokens, quality_kn, revisits, toxicity, weighted_sampling
from chanloom.llm.components import components
from chanloom.llm.tokenizer_files import byte_bpe

CLASH = "size long, score double, key string, word string, text__ string, uid long, kept boolean, task long, copies int, shard int, g string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"
LABELS = "doc_id long, quality int, toxic int"


def _rows():
    junk = (1, 0.5, "k", "w", "t", 7, True, 3, 2, 1, "g")
    prose = "plain words make a plain sentence here and there again today"
    texts = [
        (1, "", "en", "a"), (2, None, "en", "a"), (3, "   \t\n ", None, None), (4, "one", "en", "b"), (5, prose, "en", "b"), (5, prose, "en", "b"),
        (5, prose + " other", "en", None), (None, "no id at all", "fr", "c"), (None, "no id at all", "fr", "c"), (None, None, None, None),
        (6, prose.replace(" ", "  "), "en", "a"), (7, "long " * 40_000, "en", "a"), (8, "1" * 60_000, "de", "a"), (9, "a@b." + "c." * 20_000 + "d", "de", "a"),
        (10, "1-" * 50_000 + "1", "de", "b"), (11, "😀 漢字 \x00 \x02 <|endoftext|> ü", "de", "b"), (12, "x" * 100_000, None, "b"), (0, "  nbsp", "en", "z"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), *junk) for i, t, lang, s in texts]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("edges") / "docs")
    spark.createDataFrame(_rows(), SCHEMA).coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 1, 1), (6, 1, None), (7, 0, 0), (None, 1, 1), (5, 1, 1)], LABELS)


OPERATORS = {
    "mixing": lambda d, l: mixing.mix_sources(d),
    "sampling": lambda d, l: weighted_sampling.edited_fingerprints(d),
    "pii": lambda d, l: pii.personal_data(d),
    "cuckoo": lambda d, l: cuckoo.duplicates(d),
    "tokens": lambda d, l: prefix_tokens.token_counts(d, byte_bpe()),
    "jaccard": lambda d, l: jaccard_join.near_duplicates(d),
    "toxicity": lambda d, l: toxicity.toxicity(d, l),
    "quality": lambda d, l: quality_kn.quality(d, l),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_document(docs, labels, name):
    out = OPERATORS[name](docs, labels).collect()
    assert len(out) == len(_rows())
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == sorted((r[0] is None, r[0] or 0) for r in _rows())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(docs, labels, name):
    assert OPERATORS[name](docs.limit(0), labels.limit(0)).collect() == []


def test_no_labels(docs, labels):
    assert {r.score for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.0}
    assert {r.score for r in toxicity.toxicity(docs, labels.sparkSession.range(20).selectExpr("id doc_id", "1 quality", "1 toxic")).collect()} == {1.0}
    assert all(r.kept for r in quality_kn.quality(docs, labels.limit(0)).collect())


def test_cuckoo_ties(docs):
    out = [r for r in cuckoo.duplicates(docs).collect()]
    prose = [r for r in out if r.doc_id in (5, 6) and r.keep_id == 5 and r.group_size == 3]
    assert len(prose) == 3 and sum(r.kept for r in prose) == 1
    empty = [r for r in out if r.keep_id == 1]
    assert sorted(map(str, (r.doc_id for r in empty))) == ["1", "2", "None"]
    kept = cuckoo.keep_first(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.kept for r in out) == len({r.text_sha256 for r in out})


def test_index_updates(spark, docs):
    digest = docs.select("doc_id", cuckoo.digest_of(docs["text"]).alias("digest")).where("text is not null")
    index = cuckoo.build_index(digest, 3)
    n = index.count()
    gone = index.orderBy("digest").limit(2).select("digest").persist()
    after = cuckoo.update_index(index, None, gone, 3)
    assert after.count() == n - 2
    again = cuckoo.update_index(after, digest, gone, 3)
    assert again.count() == n
    assert cuckoo.update_index(index.limit(0), None, None, 3).count() == 0


def test_jaccard_of_copies(docs):
    out = jaccard_join.near_duplicates(docs).collect()
    prose = [r for r in out if r.doc_id in (5, 6)]
    # 8 of 9 shingles are shared with the longer text
    assert {r.class_id for r in prose} == {5} and {r.n_links for r in prose} == {3}
    assert all(r.n_links == 3 for r in out if r.doc_id in (1, 2, 3))  # with the null row
    kept = jaccard_join.keep_one_of_each(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 5").count() == 1 and kept.where("doc_id = 6").count() == 0


def test_packing_covers_every_document(docs):
    out = packing.pack(docs, byte_bpe(), window=64).collect()
    total = sum(r.length for r in out)
    tokens = prefix_tokens.token_counts(docs, byte_bpe()).collect()
    assert total == sum(r.n_tokens + 1 for r in tokens)
    per = {}
    for r in out:
        per.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in per.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 64
    assert packing.pack(docs.limit(0), byte_bpe()).collect() == []


def test_prefix_questions(docs):
    stored = prefix_tokens.prefix_table(docs, byte_bpe())
    rows = stored.select("doc_id", prefix_tokens.tokens_up_to(stored.prefix_tokens, 3).alias("n"), prefix_tokens.longest_prefix(stored.prefix_tokens, 2).alias("k")).collect()
    got = {r.doc_id: (r.n, r.k) for r in rows}
    assert got[4] == (1, 3) and got[1] == (0, 0) and got[7][1] == 9  # "long long"


def test_sampling_of_empty_and_equal_texts(docs):
    rows = weighted_sampling.edited_fingerprints(docs).collect()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].fingerprint == by_id[2].fingerprint == by_id[3].fingerprint == "0" * 256
    assert by_id[1].near_next == 1.0 and by_id[3].near_next == 0.0
    assert by_id[6].fingerprint in {r.fingerprint for r in rows if r.doc_id == 5}


def test_components_of_a_chain(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)]
    out = {r.node: r.root for r in components(spark.createDataFrame(chain, "a int, b int")).collect()}
    assert out == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_pii_recovers_what_the_base_drops(spark):
    card = "4539578763621486"
    text = f"pay {card} {card} or token = {'0a' * 20} now"
    out = pii.personal_data(spark.createDataFrame([(i, text + f" {i}.") for i in range(40)], "doc_id long, text string")).first()
    assert out.n_card == 0 and "secret:" in out.spans and out.spans.count("card:") == 2


def test_stages_keep_columns(spark, docs, tmp_path):
    spark.createDataFrame([(i, 1, 0) for i in range(12)], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, str(tmp_path))
        if name != "pack_sequences":
            assert out.columns == docs.columns, name
            out.write.parquet(str(tmp_path / name))
            rows = spark.read.parquet(str(tmp_path / name))
        else:
            assert out.count() > 0


def test_revisits(spark):
    h = lambda **x: {k.replace("_", "-"): v for k, v in x.items()}
    rows = [
        ("r1", "response", "http://WWW.a.com/x/", 100, 200, h(ETag='"1"', Content_Type="t", Date="d1"), "p1"),
        ("r2", "response", "https://a.com:443/x?utm_source=q", 200, 200, h(ETag='"2"', Vary="v"), "p2"),
        ("r0", "response", "https://a.com/x", 200, 200, None, "p0"),
        ("bad", "response", "http://a.com/x", 250, 404, h(ETag='"3"'), "p3"),
        ("v1", "revisit", "http://a.com/x#f", 150, 304, h(ETag='W/"1"', Date="d9", Set_Cookie="c"), None),
        ("v2", "revisit", "http://a.com/x", 200, 304, h(ETag='"1"'), None),
        ("v3", "revisit", "http://a.com/x", 400_000, 304, h(etag='"2"'), None),
        ("v4", "revisit", "http://a.com/x", 300, 304, h(ETag='"1"'), None),
        ("v5", "revisit", "http://a.com/x", 300, 304, None, None),
        ("v6", "revisit", "http://a.com/x", 300, 304, None, "p2"),
        ("v7", "revisit", "http://a.com/x", 50, 304, h(ETag='"1"'), None),
        ("v8", "revisit", None, 300, 304, h(ETag='"1"'), None),
        ("v9", "revisit", "http://a.com/x", None, 304, h(ETag='"1"'), None),
        ("v9", "revisit", "http://a.com/x", None, 304, h(ETag='"1"'), None),
    ]
    schema = "record_id string, type string, url string, ts long, status int, headers map<string,string>, payload_digest string"
    records = spark.createDataFrame(rows, schema)
    out = revisits.resolve_revisits(records).collect()
    got = {r.record_id: (r.state, r.response_id, r.payload_digest) for r in out}
    assert len(out) == 10
    assert got["v1"] == ("resolved", "r1", "p1") and got["v2"] == ("resolved", "r1", "p1") and got["v3"] == ("resolved", "r2", "p2")
    assert got["v4"][0] == "mismatch" and got["v5"][0] == "no_validator" and got["v6"] == ("resolved", "r2", "p2")
    assert got["v7"][0] == got["v8"][0] == got["v9"][0] == "no_response"
    assert next(r.headers for r in out if r.record_id == "v1") == 'content-type: t\ndate: d9\netag: W/"1"'
    assert revisits.resolve_revisits(records.limit(0)).collect() == []
    assert revisits.page_records(spark.createDataFrame([(1, None, None)], "page_id long, url string, html string")).count() == 2


def test_sampling_of_repeated_neighbours_is_linear(spark):
    """Two neighbours that repeat 1,500 times each are compared once."""
    rows = [(k % 2, f"{'left' if k % 2 else 'right'} " + "word other " * 60) for k in range(3_000)]
    out = weighted_sampling.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 3_000 and out.distinct().count() == 2
    assert "NestedLoop" not in plan


def test_revisits_of_a_hot_url_in_one_hour(spark):
    """All captures of one URL in an hour: any cut gives the same rows, and no
    window holds more than a second of them."""
    from pyspark.sql import functions as F

    rows = [(f"{i:05}", "response" if i % 3 else "revisit", "http://h/x" if i % 4 else "http://h/y", 1_700_000_000 + (i * 37) % 3_600, 200, {"ETag": f"e{i % 5}", "Date": str(i)}, f"d{i % 5}", "clash", 1)
            for i in range(4_000)]
    records = spark.createDataFrame(rows, "record_id string, type string, url string, ts long, status int, headers map<string,string>, payload_digest string, bucket string, url_key int")
    whole = sorted(map(tuple, revisits.resolve_revisits(records).collect()))
    assert whole == sorted(map(tuple, revisits.resolve_revisits(records, bucket_rows=100).collect()))
    assert whole == sorted(map(tuple, revisits.resolve_revisits(records, bucket_rows=3).collect()))
    keyed = records.select(F.col("url").alias("url_key"), "ts")
    sizes = revisits._bucketed(keyed, 86_400, 100).groupBy("url_key", "bucket").count().agg(F.max("count")).first()[0]
    assert sizes <= 100
