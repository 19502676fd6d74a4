"""op12: measures, votes, expectation-maximisation and verdict by direct Python."""

import collections
import math
import random

import numpy as np
import pytest
import regex

from chanloom.llm import quality_rules as rules
from chanloom.llm import queries

SF = "/root/testdata/sf0.001"
CLASH = "n_words string, n int, posterior string, v_size int, kept string"


def words(text):
    return regex.findall(r"[^\x20\x09-\x0D]+", text)


def base(text):
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    places = collections.defaultdict(list)
    for i in range(len(w) - 7):
        places[tuple(w[i: i + 8])].append(i)
    covered = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(8)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


def cast(text):
    """The votes of one text."""
    w, b = words(text), base(text)
    n = max(1, len(w))
    lines = [x for x in text.split("\n") if words(x)]
    share = lambda flags: sum(flags) / n
    vote = lambda good, bad, on=True: -1 if not on else 0 if bad else 1 if good else -1
    upper, cased = len(regex.findall(r"\p{Lu}", text)), len(regex.findall(r"[\p{Lu}\p{Ll}]", text))
    size, symbols, dup, window = b["word_chars"] / n, b["n_symbols"] / n, b["n_dup_lines"] / max(1, len(lines)), b["n_repeat_words"] / n
    capitals, stutter = upper / max(1, cased), share(x == y for x, y in zip(w, w[1:]))
    top = max(collections.Counter(w).values(), default=0) / n
    letters, marks = share(bool(regex.search(r"[\p{L}\p{M}]", x)) for x in w), share(bool(regex.search(r"[\p{P}\p{S}]{2}", x)) for x in w)
    variety = sum(len(set(w[i: i + 50])) for i in range(0, len(w), 50)) / n
    small = share(x in rules.SMALL_WORDS for x in w)
    some = bool(w)
    return [vote(len(w) >= 50 and small >= 0.01, len(w) < 20, some), vote(3 <= size <= 10, size < 2 or size > 20, some), vote(symbols <= 0.02, symbols > 0.1, some),
            vote(dup <= 0.1, dup > 0.3, len(lines) >= 4), vote(window <= 0.1, window > 0.3, len(w) >= 16), vote(capitals <= 0.2, capitals > 0.5, cased >= 20),
            vote(stutter <= 0.02, stutter > 0.2, len(w) >= 5), vote(top <= 0.15, top > 0.3, len(w) >= 20),
            vote(variety >= 0.5, variety < 0.3, len(w) >= 20), vote(letters >= 0.8, letters < 0.6, some),
            vote(marks <= 0.1, marks > 0.3, some)]


def learn(votes):
    """The expectation-maximisation, one document at a time."""
    belief = [(0.95, 0.5, 0.05)[min(2, v.count(0))] for v in votes]
    for _ in range(rules.ROUNDS):
        prior = (sum(belief) + 1) / (len(votes) + 2)
        right = []
        for k in range(len(rules.RULES)):
            good = sum(p for p, v in zip(belief, votes) if v[k] >= 0)
            bad = sum(1 - p for p, v in zip(belief, votes) if v[k] >= 0)
            yes = sum(p for p, v in zip(belief, votes) if v[k] == 1)
            no = sum(1 - p for p, v in zip(belief, votes) if v[k] == 0)
            right.append((min(rules.MOST, max(rules.LEAST, (yes + 4) / (good + 5))), min(rules.MOST, max(1e-4, (no + 4) / (bad + 5)))))
        belief = []
        for v in votes:
            odds = math.log(prior / (1 - prior))
            for x, (g, b) in zip(v, right):
                odds += 0 if x < 0 else math.log(g / (1 - b)) if x == 1 else math.log((1 - g) / b)
            belief.append(1 / (1 + math.exp(-odds)))
    return belief


def expected(texts):
    texts = [t or "" for t in texts]
    votes = [cast(t) for t in texts]
    out = []
    for t, v, p in zip(texts, votes, learn(votes)):
        b = base(t)
        failed = b["n_words"] < 20 or 100 * b["n_repeat_words"] > 30 * b["n_words"]
        out.append((b, v, failed, p))
    return out


def agree(rows, want):
    for r, (b, v, failed, p) in zip(rows, want):
        assert {c: r[c] for c in rules.MEASURES} == b
        assert [r[c] for c in rules.RULES] == v
        assert r.base_failed == failed and abs(r.posterior - p) < 1e-6
        assert r.kept == (not failed and p >= 0.5) or abs(p - 0.5) < 1e-6


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    rows = sorted(queries.QUERIES["op12_quality_rules"](spark, SF).collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in rows] == [d.doc_id for d in docs]
    agree(rows, expected([d.text for d in docs]))


def test_odd_texts(spark):
    random.seed(12)
    parts = ["the", "a", "Und", "x!!", "##", "é", "漢字", "कि", "\n", "\n\n", " \n", "\t", " ", "  ", "7", "\x0b", "\xa0", "WORD", "|", "😀", "the line\n", "\r\n"]
    texts = ["".join(random.choice(parts) + random.choice([" ", "", " "]) for _ in range(random.randint(0, 90))) for _ in range(250)]
    texts += [None, "", " ", "\n\n\n", "same words here " * 7, "one two three four five six seven eight " * 2, "w " * 5_000, "x" * 60_000, "same", "same"]
    df = spark.createDataFrame([(i, t, "x", 1, "y", 2, "z") for i, t in enumerate(texts)], f"doc_id long, text string, {CLASH}").repartition(3)
    agree(sorted(rules.judged(df).collect(), key=lambda r: r.doc_id), expected(texts))


def test_empty_table_and_null_ids(spark):
    assert rules.judged(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    rows = rules.judged(spark.createDataFrame([(None, None), (None, "")], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.n_words, r.base_failed, r.kept) for r in rows] == [(None, 0, True, False)] * 2


def test_verdict_against_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op12_quality_rules"](spark, sf).collect() if r.doc_id in labels and not r.base_failed]
    good = [r.kept for r in rows if labels[r.doc_id] == 1]
    junk = [r.kept for r in rows if labels[r.doc_id] == 0]
    assert np.mean(good) > 0.99 and np.mean(junk) < 0.02
    # a document that fails one rule is not lost for that alone
    assert any(r.kept and any(r[v] == 0 for v in rules.RULES) for r in rows) or not any(sum(r[v] == 0 for v in rules.RULES) == 1 for r in rows)


@pytest.mark.parametrize("wrong", [0, 4])
def test_reliabilities_of_known_rules(wrong):
    """Votes drawn from known accuracies: the estimates come near them."""
    rng = np.random.default_rng(5)
    right = np.array([(0.97, 0.6)] * len(rules.RULES))
    right[wrong] = (0.7, 0.4)
    good = rng.random(20_000) < 0.85
    votes = np.where(good[:, None], rng.random((20_000, len(right))) < right[:, 0], rng.random((20_000, len(right))) >= right[:, 1]).astype(int)
    votes[rng.random(votes.shape) < 0.1] = -1
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    prior, found = rules.reliabilities(patterns, counts.astype(float))
    assert abs(prior - 0.85) < 0.02 and np.abs(found - right).max() < 0.05
