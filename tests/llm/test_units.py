"""Small exact checks of the operators' parts, without tables."""

import collections
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chanloom.llm import bpe, cuckoo, jaccard_join, mixing, packing, prefix_tokens, quality_kn, toxicity
from chanloom.llm.common import offsets, ranges
from chanloom.llm.tokenizer_files import byte_bpe

tokenizers = pytest.importorskip("tokenizers")

PARTS = ["a", "'", "s", "re", "ll", "'ve", " ", "  ", "\n", "\t", "　", "1", "é", "漢", "😀", ".", "!!", "<|endoftext|>",
         "<|endof", "the", "\x1c", "́", "½", "\x85", "​", "\xa0"]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=14).map("".join)


@pytest.fixture(scope="module")
def reference():
    t = tokenizers.Tokenizer.from_file(byte_bpe())
    return lambda text: t.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXTS, max_size=8))
def test_ids_equal_the_library(reference, texts):
    ids, at = bpe.encode_texts(texts, byte_bpe())
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [reference(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_prefix_counts_equal_encoding_each_prefix(reference, texts):
    counts, at = prefix_tokens.prefix_counts(texts, byte_bpe())
    for i, t in enumerate(texts):
        assert counts[at[i]: at[i + 1]].tolist() == [len(reference(t[:k])) for k in range(1, len(t) + 1)]


def test_long_pieces(reference):
    texts = ["a" * 5000, "1 " * 3000, " " * 3000 + "x", "'" * 200, "é" * 999]
    ids, at = bpe.encode_texts(texts, byte_bpe())
    counts, ends = prefix_tokens.prefix_counts(texts, byte_bpe())
    for i, t in enumerate(texts):
        assert ids[at[i]: at[i + 1]].tolist() == reference(t)
        assert counts[ends[i + 1] - 1] == len(reference(t))


@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 6)), max_size=12))
def test_ranges(pairs):
    starts, sizes = (np.array([p[i] for p in pairs], np.int64) for i in (0, 1))
    want = [x for s, n in pairs for x in range(s, s + n)]
    assert ranges(starts, sizes).tolist() == want
    assert offsets(sizes)[-1] == len(want)


def test_cuckoo_index_against_a_dict():
    rng = random.Random(5)
    index, model = cuckoo.CuckooIndex(capacity=4), {}
    digests = [f"{rng.getrandbits(256):064x}" for _ in range(3000)]
    # equal 64-bit keys with different digests must stay apart
    digests += [d[:16] + d[16:32] + f"{rng.getrandbits(128):032x}" for d in digests[:300]]
    for step in range(20_000):
        d = rng.choice(digests)
        if rng.random() < 0.3:
            assert index.delete(d) == (model.pop(d, None) is not None)
        else:
            assert index.insert(d, step) == (d not in model)
            model.setdefault(d, [step, 0])[1] += 1
    assert index.live == len(model) and index.resizes > 3
    assert sorted(map(tuple, index.entries())) == sorted((d, *v) for d, v in model.items())


def test_pivot_keeps_words_and_expectations():
    rng = np.random.default_rng(3)
    p, size = rng.random(40), rng.integers(1, 30, 40).astype(float)
    total = np.zeros(40)
    for _ in range(4000):
        out = mixing.pivot(p, size, rng.random(40))
        left = (out > 0) & (out < 1)
        assert left.sum() <= 1
        assert abs((out * size).sum() - (p * size).sum()) < 1e-6
        total += out
    assert np.abs(total / 4000 - p).max() < 0.05


def test_least_matches_by_simulation():
    least = jaccard_join.least_matches()
    assert least == sorted(least) and len(least) == jaccard_join.HASHES // jaccard_join.STEP
    # a pair at the threshold hardly ever falls below
    rng = np.random.default_rng(1)
    p = 0.8 + 0.2 / 256
    hits = np.cumsum(rng.random((200_000, jaccard_join.HASHES)) < p, axis=1)[:, jaccard_join.STEP - 1:: jaccard_join.STEP]
    assert (hits < np.array(least)).any(axis=1).mean() < 1e-4


def test_signatures_estimate_jaccard():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    a = [rng.choice(words) for _ in range(600)]
    b = list(a)
    for i in range(0, 600, 60):
        b[i] = "other"
    hashes, at = jaccard_join.shingles([" ".join(a), " ".join(b), "", "one two"])
    assert np.diff(at).tolist() == [596, 596, 0, 1]
    s = jaccard_join.signatures(hashes, at)
    x, y = (set(hashes[at[i]: at[i + 1]].tolist()) for i in (0, 1))
    assert abs((s[0] == s[1]).mean() - len(x & y) / len(x | y)) < 0.12


def _kneser_ney(words, order=5):
    """Direct interpolated modified Kneser-Ney over padded words."""
    grams = collections.Counter()
    for w in words:
        s = "\x02" * (order - 1) + w + "\x03"
        grams.update(s[i: i + order] for i in range(len(s) - order + 1))
    return grams, _direct(grams, order)


def _direct(grams, order=5):
    counts = [None] * (order + 1)
    counts[order] = grams
    for k in range(order - 1, 0, -1):
        counts[k] = collections.Counter(g[1:] for g in counts[k + 1])

    def discounts(c):
        n = [sum(v == i for v in c.values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0.5
        out = []
        for i, a, b in ((1, n[1], n[2]), (2, n[2], n[3]), (3, n[3], n[4])):
            out.append(min(max(i - (i + 1) * y * b / a, 0.05), i - 0.05) if a and b else 0.75)
        return out

    def p(g):
        if not g:
            return 1 / (len(counts[1]) + 1)
        c, d = counts[len(g)], discounts(counts[len(g)])
        row = {x: v for x, v in c.items() if x[:-1] == g[:-1]}
        if not row:
            return p(g[1:])
        cut = lambda v: d[min(v, 3) - 1]
        total = sum(row.values())
        return max(c.get(g, 0) - (cut(c[g]) if g in c else 0), 0) / total + sum(map(cut, row.values())) / total * p(g[1:])

    return p


def test_gram_probabilities_equal_a_direct_model(spark):
    words = ["the", "then", "thin", "tin", "at", "hat", "the", "that", "other", "to", "too", "ten"]
    grams, p = _kneser_ney(words)
    asked = [*grams, "\x02\x02\x02\x02z", "\x02\x02thx", "abcde", "\x02then"]
    counts = spark.createDataFrame(list(grams.items()), "g string, c long")
    got = quality_kn.gram_log_probabilities(counts, spark.createDataFrame([(g,) for g in asked], "g string")).collect()
    assert len(got) == len(set(asked))
    for r in got:
        assert math.isclose(math.exp(r.logp), p(r.g), rel_tol=1e-9), r.g


def test_symbols_with_repeats():
    stream, places, doc, repeated, fresh = quality_kn.symbol_stream(["ab ab  c", "", "\x02 ab", "漢a"])
    grams = ["".join(chr(stream[p - 4 + k]) for k in range(5)) for p in places]
    assert grams[:5] == ["\x02\x02\x02\x02a", "\x02\x02\x02ab", "\x02\x02ab\x03", "\x03ab\x03c", "ab\x03c\x03"]
    assert doc.tolist() == [0] * 5 + [2] * 5 + [3] * 3 and grams[5] == "\x02\x02\x02\x02\ufffd"
    assert repeated.tolist() == [1, 0, 0, 0] and fresh.tolist() == [1, 0, 1, 0]
    keys, wide = quality_kn.gram_keys(quality_kn._columns(stream, places))
    assert len(set(keys.tolist())) == len(set(grams)) and wide.tolist() == [any(ord(c) >= 4096 for c in g) for g in grams]
    held = quality_kn._Counter()
    for _ in range(3):
        held.add(["ab ab  c", "", "\x02 ab", "漢a"])
    strings, counts = held.flush()
    want = collections.Counter({g: 3 * n for g, n in collections.Counter(grams).items()})
    want.update({"\x02\x02\x02\x02\x04": 3, "\x02\x02\x02\x02\x05": 6})
    assert dict(zip(strings, counts.tolist())) == want


def _symbols(text):
    """A document's predictions by the definition: (context, symbol) pairs."""
    words = [w for w in re.split("[\x20\x09-\x0D]+", text) if w]
    out, before, seen = [], "\x02" * 4, set()
    for i, w in enumerate(words):
        w = "".join("\ufffd" if ord(c) <= 5 else c for c in w)
        phrase = tuple(words[i - 3: i + 1]) if i >= 3 else None
        repeats = (i > 0 and words[i - 1] == words[i]) or phrase in seen
        seen |= {phrase} - {None}
        if repeats:
            out.append("\x02\x02\x02\x02\x04")
        elif i:
            out.append("\x02\x02\x02\x02\x05")
        for c in w + "\x03":
            if not repeats:
                out.append(before[-4:] + c)
            before += c
    return out


def test_quality_equals_a_direct_model(spark, tmp_path):
    """Perplexity, threshold and verdict of the whole operator."""
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdeé漢") for _ in range(rng.randint(1, 4))) for _ in range(25)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 14))), rng.choice(["x", "y", None])) for i in range(90)]
    rows += [(90 + i, "zz qq " * 9, "x") for i in range(3)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).write.parquet(path)
    docs = spark.read.parquet(path)
    good = [i for i in range(90) if i % 4]
    fold = {r.doc_id: r.f for r in docs.selectExpr("doc_id", "pmod(xxhash64(cast(doc_id as string)), 5) f").collect()}
    grams = collections.Counter(g for i, t, _ in rows if i in good and fold[i] for g in _symbols(t))
    p = _direct(grams)
    scored = {i: (sum(math.log(p(g)) for g in _symbols(t)), sum(g[-1] != "\x05" or g[0] != "\x02" for g in _symbols(t))) for i, t, _ in rows}
    cal = [i for i in good if not fold[i]]
    spoken = [i for i in cal if scored[i][1]]
    mu = -sum(scored[i][0] for i in spoken) / sum(scored[i][1] for i in spoken)
    perplexity = {i: math.exp((-s + 60 * mu) / (n + 60)) for i, (s, n) in scored.items()}
    limit = sorted(perplexity[i] for i in cal)[max(0, math.ceil(0.995 * len(cal)) - 1)] * 1.1
    labels = spark.createDataFrame([(i, 1) for i in good], "doc_id long, quality int")
    for r in quality_kn.quality(docs, labels).collect():
        assert r.n_symbols == scored[r.doc_id][1]
        assert math.isclose(r.perplexity, perplexity[r.doc_id], rel_tol=1e-5)
        assert math.isclose(r.threshold, limit, rel_tol=1e-5) and r.kept == (r.perplexity <= r.threshold)


def test_quality_sees_word_order_and_returning_phrases(spark, tmp_path):
    rng = random.Random(8)
    nouns, verbs = (["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 7))) for _ in range(80)] for _ in range(2))
    prose = lambda: " ".join(f"The {rng.choice(nouns)} will {rng.choice(verbs)} a {rng.choice(nouns)}." for _ in range(40))
    texts = [prose() for _ in range(400)]
    junk = []
    for _ in range(20):
        words = prose().split()
        mixed = rng.sample(words, len(words))
        junk += [" ".join(mixed), " ".join(words[:2] * 100), " ".join(words[:9] * 25)]
    path = str(tmp_path / "docs")
    spark.createDataFrame([(i, x, "en") for i, x in enumerate(texts + junk)], "doc_id long, text string, lang string").write.parquet(path)
    labels = spark.createDataFrame([(i, 1) for i in range(380)], "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in quality_kn.quality(spark.read.parquet(path), labels).collect()}
    assert sum(kept[i] for i in range(400)) >= 390
    for kind in range(3):
        assert sum(kept[i] for i in range(400 + kind, 460, 3)) <= 2


def _bm25(query, doc, idf, mean):
    return sum(idf[t] * f * (packing.K1 + 1) / (f + packing.K1 * (1 - packing.B + packing.B * len(doc) / mean))
               for t, f in collections.Counter(doc.tolist()).items() if t in set(query.tolist()))


def test_bm25_scores_and_windows():
    docs = [np.array(x, np.int64) for x in ([5, 5, 6], [5, 9], [7, 7, 7, 7], [6, 9])]
    idf = np.array([0, 0, 0, 0, 0, 0.7, 0.7, 1.2, 0, 0.7])
    index = packing.Shard(docs, idf, 2.75)
    got = index.scores(0)
    for d, own in enumerate(docs):
        assert math.isclose(got[d], _bm25(docs[0], own, idf, 2.75), abs_tol=1e-5)
    pieces = packing.fill_windows(docs, index, 4)
    assert pieces[0] == (0, 0, 3, 0, 0) and pieces[1][0] in (1, 3)
    cover = collections.defaultdict(int)
    for d, begin, n, sequence, at in pieces:
        assert begin == cover[d]
        cover[d] += n
    assert cover == {d: len(x) for d, x in enumerate(docs)}
    fill = collections.Counter()
    for _, _, n, sequence, at in pieces:
        assert at == fill[sequence]
        fill[sequence] += n
    assert sorted(fill.values()) == [3, 4, 4]


def test_frequent_and_rare_terms_and_the_greedy_fill():
    """Scores of both halves of the index, and that a seed takes its best
    unused neighbours in order."""
    rng = np.random.default_rng(9)
    docs = [np.concatenate([rng.integers(0, 12, 30), rng.integers(12, 400, 20)]) for _ in range(80)]
    idf = np.concatenate([rng.uniform(0.1, 0.3, 12), rng.uniform(2, 4, 388)])
    index = packing.Shard(docs, idf, 50.0)
    assert index.close.any() and len(index.owner)
    scores = np.array([index.scores(i) for i in range(80)])
    want = np.array([[_bm25(q, d, idf, 50.0) for d in docs] for q in docs])
    off = ~np.eye(80, dtype=bool)  # a document's own rare terms are left out of its own score
    assert np.abs(scores - want)[off].max() < 1e-3
    used, by_sequence = set(), collections.defaultdict(list)
    for piece in packing.fill_windows(docs, index, 200):
        by_sequence[piece[3]].append(piece)
    for sequence in sorted(by_sequence):
        (seed, *_), *taken = by_sequence[sequence]
        used.add(seed)
        for d, begin, *_ in taken:
            assert begin == 0
            assert want[seed][d] >= max(want[seed][k] for k in range(80) if k not in used) - 1e-3
            used.add(d)


def _rests(spark, rows):
    rows = [(i, i, 0, len(r), np.array(r, "<u2").tobytes()) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, "rid long, uid long, start long, length long, ids binary")


def test_close_rests_share_a_shard(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCS", 30)
    monkeypatch.setattr(packing, "CELL_DOCS", 100)
    rng = np.random.default_rng(6)
    topics = np.arange(600) % 60
    rests = _rests(spark, [[*rng.integers(1000 + 40 * t, 1040 + 40 * t, 25).tolist(), *rng.integers(10, 40, 25).tolist()] for t in topics])
    idf = np.where(np.arange(4000) >= 1000, 3.0, 0.1)
    shard = {r.rid: r.shard for r in packing.placed(rests, lambda: idf, 50.0).collect()}
    assert len(shard) == 600 and len(set(shard.values())) <= 40
    assert max(collections.Counter(shard.values()).values()) < 60
    found = [shard[i] == shard[j] for i in range(600) for j in range(i) if topics[i] == topics[j]]
    assert np.mean(found) > 0.6  # by chance: 1/20


def test_equal_rests_are_cut_to_bounded_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCS", 30)
    rows = packing.placed(_rests(spark, [[5, 6, 7]] * 300 + [[9, 8]] * 20), lambda: np.ones(10), 3.0).collect()
    sizes = collections.Counter(r.shard for r in rows)
    assert len(rows) == 320 and max(sizes.values()) < 60


def test_one_row_repeated_is_spread(spark, monkeypatch):
    """Rows that repeat doc_id and text share no shard beyond its bound."""
    monkeypatch.setattr(packing, "SHARD_DOCS", 500)
    df = spark.createDataFrame([(7, "one and the same text"), (None, None)], "doc_id long, text string").crossJoin(spark.range(10_000)).drop("id").repartition(5)
    out = packing.pack(df, byte_bpe(), window=64).collect()
    shards = collections.Counter(r.sequence_id >> 32 for r in out)
    assert sum(r.length for r in out if r.doc_id == 7 and r.start == 0) >= 10_000 and max(shards.values()) < 1_500
    fill = collections.Counter()
    for r in out:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 64 and sum(n < 64 for n in fill.values()) <= len(shards)


def test_rare_offensive_words_are_features(spark):
    rng = random.Random(3)
    common = ["".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(1_500)]
    rare = ["zzqkv", "wwxqz", "yyvkq"]
    rows = [(i, " ".join(rng.sample(common, 700 if i < 60 else 200)) + (f". {rare[i // 2 % 3]}" if i < 24 else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(400)], "doc_id long, toxic int")
    hashes, w, _ = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert len(hashes) > 4_096
    for word in rare:
        assert w[hashes == toxicity.Sentences([word]).features[0]] > 0


def test_noisy_or_learns_from_document_labels():
    rng = np.random.default_rng(4)
    bags, label = [], []
    for _ in range(400):
        sentences = [rng.integers(1, 20, 3).tolist() for _ in range(int(rng.integers(1, 6)))]
        y = rng.random() < 0.4
        if y:
            sentences[0].append(0)
        bags.append(np.array([x for s in sentences for x in [*s, -1]], np.int32))
        label.append(int(y))
    w, b = toxicity.fit_noisy_or(bags, np.zeros(400), np.array(label), np.ones(400), 20)
    assert w[0] > 3 and np.abs(w[1:]).max() < w[0] / 2 and b < 0
