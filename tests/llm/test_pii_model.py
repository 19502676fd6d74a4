"""op3: expectation-maximisation, posterior, classifier and choice by plain
Python, and the context of a span."""

import collections
import itertools
import math
import random

from pyspark.sql import functions as F

from chanloom.llm import pii


def learn(patterns, rounds=pii.ROUNDS):
    """EM over (votes, count) pairs from majority votes."""
    belief = [0.9 if sum(2 * v - 1 for v in p if v >= 0) > 0 else 0.1 for p, _ in patterns]
    for _ in range(rounds):
        prior = (sum(n * b for (_, n), b in zip(patterns, belief)) + 1) / (sum(n for _, n in patterns) + 2)
        rates = []
        for k in range(len(pii.LABELERS)):
            on = [(p[k], n * b, n * (1 - b)) for (p, n), b in zip(patterns, belief) if p[k] >= 0]
            rates.append(((sum(t for v, t, _ in on if v) + 1) / (sum(t for _, t, _ in on) + 2), (sum(f for v, _, f in on if v) + 1) / (sum(f for *_, f in on) + 2)))
        belief = []
        for p, _ in patterns:
            odds = math.log(prior / (1 - prior))
            for v, (yes, no) in zip(p, rates):
                odds += 0 if v < 0 else math.log(yes / no) if v else math.log((1 - yes) / (1 - no))
            belief.append(1 / (1 + math.exp(-odds)))
    return prior, rates, belief


def test_reliabilities_and_posterior(spark):
    rng = random.Random(3)
    votes = []
    for _ in range(3_000):
        true = rng.random() < 0.4
        votes.append(tuple(-1 if rng.random() < 0.15 else int(rng.random() < (0.85 if true else 0.2 + 0.05 * k)) for k in range(5)))
    counts = collections.Counter(votes)
    prior, rates, belief = learn(sorted(counts.items()))
    df = spark.createDataFrame(votes, ", ".join(f"{v} int" for v in pii.LABELERS))
    got_prior, got = pii.reliabilities(df)
    assert math.isclose(got_prior, prior, rel_tol=1e-9)
    for v, want in zip(pii.LABELERS, rates):
        assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(got[v], want))
    assert abs(got_prior - 0.4) < 0.05 and got["v_pattern"][0] > 0.75
    want = dict(zip(sorted(counts), belief))
    for r in df.distinct().withColumn("p", pii.posterior(got_prior, got)).collect():
        assert math.isclose(r.p, want[tuple(r)[:-1]], rel_tol=1e-9)


def test_classifier_is_naive_bayes(spark):
    rng = random.Random(5)
    rows = [(False, i, 0, "email", i, i + 5, False, *[rng.randint(0, 1) for _ in pii.LABELERS], *[f"email/{rng.randint(0, 3)}" for _ in pii.FEATURES]) for i in range(200)]
    names = ["k_none boolean", "k_id long", "k_text long", "kind string", "start long", "end long", "is_base boolean", *[f"{v} int" for v in pii.LABELERS], *[f"{f} string" for f in pii.FEATURES]]
    df = spark.createDataFrame(rows, ", ".join(names))
    rates = {v: (0.6 + 0.05 * k, 0.3) for k, v in enumerate(pii.LABELERS)}
    belief = {r.k_id: r.p for r in df.select("k_id", pii.posterior(0.3, rates).alias("p")).collect()}
    yes, no = sum(belief.values()), sum(1 - p for p in belief.values())
    by = collections.defaultdict(lambda: [0.0, 0.0])
    for r in rows:
        for f, value in zip(pii.FEATURES, r[-len(pii.FEATURES):]):
            by[f, value][0] += belief[r[1]]
            by[f, value][1] += 1 - belief[r[1]]
    for r in pii.classified(df, 0.3, rates).collect():
        odds = math.log((yes + 1) / (no + 1))
        for f, value in zip(pii.FEATURES, rows[r.k_id][-len(pii.FEATURES):]):
            a, b = by[f, value]
            odds += math.log((a + 0.5) / (yes + 1)) - math.log((b + 0.5) / (no + 1))
        assert math.isclose(r.chance, 1 / (1 + math.exp(-odds)), rel_tol=1e-9)


def choose(spans):
    """All base spans; accepted others that meet none of them and no earlier one."""
    base = [s for s in spans if s[4]]
    out, last = list(base), None
    for kind, start, end, chance, _ in sorted((s for s in spans if not s[4] and s[3] >= pii.ACCEPT), key=lambda s: (s[1], pii.KINDS.index(s[0]), s[2])):
        if any(start < b[2] and b[1] < end for b in base):
            continue
        if last is None or last <= start:
            out.append((kind, start, end, chance, False))
        last = end if last is None else max(last, end)
    return out


def test_chosen_spans(spark):
    rng = random.Random(7)
    rows, want = [], []
    for doc in range(300):
        spans, at = [], 0
        for _ in range(rng.randint(0, 7)):
            at += rng.randint(0, 6)
            size = rng.randint(1, 6)
            spans.append((rng.choice(pii.KINDS), at, at + size, rng.choice([0.1, 0.95, 0.99]), rng.random() < 0.3))
        # base spans do not meet each other inside a kind; across kinds they may
        spans = list({(s[0], s[1], s[2]): s for s in spans}.values())
        rows += [(False, doc, 0, *s) for s in spans]
        want += [(doc, s[0], s[1], s[2]) for s in choose(spans)]
    df = spark.createDataFrame(rows, "k_none boolean, k_id long, k_text long, kind string, start long, end long, chance double, is_base boolean")
    got = [(r.k_id, r.kind, r.start, r.end) for r in pii.chosen(df).collect()]
    assert sorted(got) == sorted(want)


def test_context_reaches_over_a_neighbour(spark):
    texts = ["call 555 123 4567 or 555 123 4568", "555 123 4567 is my phone", "x" * 100 + " phone " + "y" * 100 + " 555 123 4567"]
    rows = spark.createDataFrame([(False, i, 0, t) for i, t in enumerate(texts)], "k_none boolean, k_id long, k_text long, text string")
    hits = pii.votes(pii.matches(rows)).where("kind = 'phone'").orderBy("k_id", "start").collect()
    assert [(r.k_id, r.v_context) for r in hits] == [(0, 1), (0, 1), (1, 1), (2, -1)]
    assert all(len(r.before) <= pii.NEAR and len(r.after) <= pii.NEAR for r in hits)
    second = hits[1]
    assert second.before.endswith("call 555 123 4567 or ") and texts[0][second.start:second.end] == "555 123 4568"


def test_gazetteers(spark):
    cases = list(itertools.chain(
        [("email", "a@b.fr", 1), ("email", "a@b.zzz", 0), ("ip", "8.8.8.8", 1), ("ip", "192.168.1.1", 0), ("ip", "10.0.0.1", 0), ("ip", "127.0.0.1", 0), ("ip", "19.216.8.1", 1)],
        [("card", "4111 1111 1111 1111", 1), ("card", "9111111111111111", 0), ("phone", "+33 1 23 45 67 89", 1), ("phone", "+44 20 7946 0958", 1), ("phone", "+210 123 456 789", 1), ("phone", "+83 123 456 789", 0)]))
    rows = [(False, i, 0, kind, True, 0, len(span), span, "", "") for i, (kind, span, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "k_none boolean, k_id long, k_text long, kind string, base boolean, start long, end long, span string, before string, after string")
    got = {r.k_id: r.v_gazetteer for r in pii.votes(df).select("k_id", F.col("v_gazetteer")).collect()}
    assert got == {i: want for i, (*_, want) in enumerate(cases)}
