"""The registered queries and the pipeline against direct Python versions."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from chanloom.llm import cuckoo, jaccard_join, queries
from chanloom.llm.tokenizer_files import byte_bpe

tokenizers = pytest.importorskip("tokenizers")
SF = "/root/testdata/sf0.001"
SPACE = re.compile("[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def ids():
    t = tokenizers.Tokenizer.from_file(byte_bpe())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def run(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


def test_mixing(spark, docs):
    rows = run(spark, "op1_mixing")
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    sizes = collections.Counter()
    for d in docs.values():
        sizes[d.source] += len(words(d.text))
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, held = {}, set()
    while True:  # fill, hold what is above its cap, share the rest again
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in held)
        total = sum(weight[s] for s in names if s not in held)
        target = {s: 3 * sizes[s] if s in held else left * weight[s] / total for s in names}
        above = {s for s in names if target[s] > 3 * sizes[s]} - held
        if not above:
            break
        held |= above
    taken = collections.Counter()
    for r in rows:
        assert r.size == len(words(docs[r.doc_id].text)) and r.source_size == sizes[r.source]
        assert abs(r.target - target[r.source]) < 1e-6 and r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        taken[r.source] += r.taken
    largest = collections.Counter()
    for r in rows:
        largest[r.source] = max(largest[r.source], r.size)
    for s in names:
        assert abs(taken[s] - target[s]) <= largest[s]
    again = {r.doc_id: r.taken for r in run(spark, "op1_mixing")}
    assert again == {r.doc_id: r.taken for r in rows}


def _likeness(a, b):
    a, b = collections.Counter(words(a)), collections.Counter(words(b))
    top = sum((a | b).values())
    return sum((a & b).values()) / top if top else 1.0


def test_weighted_sampling(spark, docs):
    order = sorted(docs)
    errors = []
    for r in run(spark, "op2_weighted_sampling"):
        own = docs[r.doc_id].text or ""
        after = docs[order[(order.index(r.doc_id) + 1) % len(order)]].text or ""
        edited = own[: len(own) - len(own) // 4] + after[: len(own) // 4]
        assert r.n_chars == len(own) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors += [r.near_edited - _likeness(own, edited), r.near_next - _likeness(own, after)]
    errors = np.array(errors)
    # an unbiased estimate from 32 samples
    assert abs(errors.mean()) < 0.02 and errors.std() < 0.1


BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def _holds(kind, span):
    digits = [int(c) for c in span if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in span.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def test_pii(spark, docs):
    for r in run(spark, "op3_pii"):
        found = sorted((m.start(), n, f"{k}:{m.start()}:{m.end()}") for n, (k, p) in enumerate(BASE.items())
                       for m in p.finditer(docs[r.doc_id].text or "") if _holds(k, m.group()))
        assert r.base_sha256 == hashlib.sha256(",".join(f[2] for f in found).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(f[1] == n for f in found) for n in range(4)]
        assert {f[2] for f in found} <= set(r.spans.split(","))


def test_exact_dedup(spark, docs):
    groups = collections.defaultdict(list)
    for d in docs.values():
        groups[SPACE.sub(" ", d.text or "")].append(d.doc_id)
    want = {(i, min(g), len(g), i == min(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}
    assert {tuple(r) for r in run(spark, "op5_exact_dedup")} == want


def test_token_counts(spark, docs, ids):
    for r in run(spark, "op6_token_counts"):
        n = len(ids(docs[r.doc_id].text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((docs[r.doc_id].text or "").encode()), n, n > 1024)


def _classes(texts):
    """Links and classes of all pairs by the definition."""
    sets = {}
    for i, t in texts.items():
        w = words((t or "").lower())
        sets[i] = {tuple(w[k: k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root, links = {i: i for i in texts}, collections.Counter()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    keys = sorted(sets)
    for x, i in enumerate(keys):
        for j in keys[x + 1:]:
            a, b = sets[i], sets[j]
            if a == b or (a and len(a & b) >= 0.8 * len(a | b)):
                links[i] += 1
                links[j] += 1
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: find(i) for i in keys}, links


def test_jaccard_join(spark, docs):
    classes, links = _classes({i: d.text for i, d in docs.items()})
    for r in run(spark, "op7_jaccard_join"):
        assert (r.class_id, r.n_links) == (classes[r.doc_id], links[r.doc_id])


def test_blocks_do_not_matter(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 2)
    got = {tuple(r) for r in run(spark, "op7_jaccard_join")}
    monkeypatch.undo()
    assert got == {tuple(r) for r in run(spark, "op7_jaccard_join")}


def _check_packing(rows, want, window=2048):
    """Each document's ids are covered once (as often as it occurs)."""
    sequences = collections.defaultdict(list)
    got = collections.Counter()
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        own = want[r.doc_id]
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[r.start: r.start + r.length].tobytes())
        for k in (r.start, r.start + r.length):
            got[r.doc_id, k] += 1 if k == r.start else -1
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= window
    for (doc, k), n in got.items():
        assert n == 0 or k in (0, len(want[doc]))
    return sum(r.length for r in rows) / (window * len(sequences))


def test_packing(spark, docs, ids):
    want = {i: np.array([*ids(d.text), 1], "<u4") for i, d in docs.items()}
    rows = run(spark, "op10_packing")
    assert sum(r.length for r in rows) == sum(map(len, want.values()))
    assert _check_packing(rows, want) > 0.97


def test_toxicity_held_out(spark):
    rows = {r.doc_id: r for r in queries.QUERIES["op8_toxicity"](spark, "/root/testdata/sf0.1").collect()}
    label = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [(rows[i].score, y) for i, y in label.items() if rows[i].held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 for i, r in rows.items())
    hit = sum(y for s, y in held if s >= 0.3)
    assert hit / sum(y for _, y in held) > 0.8 and hit / sum(s >= 0.3 for s, _ in held) > 0.85


def test_pipeline_stage_by_stage(spark, docs, ids, tmp_path):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    columns, now = rows.columns, dict(docs)
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:3]:
        stage(spark, rows, SF).write.parquet(str(tmp_path / name))
        rows = spark.read.parquet(str(tmp_path / name))
        out = {r.doc_id: r for r in rows.collect()}
        assert rows.columns == columns and len(out) == rows.count() and all(tuple(r) == tuple(docs[i]) for i, r in out.items())
        if name == "quality_classifier":
            kept = [i in out for i in label if label[i] == 1]
            junk = [i in out for i in label if label[i] == 0]
            assert sum(kept) >= 0.95 * len(kept) and sum(junk) <= 0.3 * len(junk)
        if name == "exact_dedup":
            first = {}
            for i in sorted(now):
                first.setdefault(SPACE.sub(" ", now[i].text or ""), i)
            assert set(out) == set(first.values())
        if name == "ngram_jaccard_join":
            classes, _ = _classes({i: r.text for i, r in now.items()})
            assert set(out) == set(classes.values())
        now = out
    mixed = corpus_pipeline.STAGES[3][1](spark, rows, SF)
    mixed.write.parquet(str(tmp_path / "mixed"))
    rows = spark.read.parquet(str(tmp_path / "mixed"))
    copies = collections.Counter(r.doc_id for r in rows.collect())
    assert rows.columns == columns and set(copies) <= set(now) and max(copies.values()) <= 3
    packed = corpus_pipeline.STAGES[4][1](spark, rows, SF).collect()
    want = {i: np.array([*ids(now[i].text), 1], "<u4") for i in copies}
    _check_packing(packed, want)
    assert sum(r.length for r in packed) == sum(len(want[i]) * n for i, n in copies.items())


def test_pipeline_runs_as_one_query(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 0


def test_oracles(spark):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    for name, sql in queries.ORACLE.items():
        rel = con.sql(sql)
        got = queries.QUERIES[name](spark, SF).select(*rel.columns)
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, rel.fetchall())), name


def test_digest_is_the_hash_of_the_normal_text(spark):
    df = spark.createDataFrame([(" a\t\n b ",)], "text string")
    assert df.select(cuckoo.digest_of(df["text"]).alias("d")).first().d == hashlib.sha256(b" a b ").hexdigest()
