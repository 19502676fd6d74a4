"""op8: the noisy-or score and the located sentences against plain Python."""

import math
import random
import re

import numpy as np
import pytest

from chanloom.llm import toxicity


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(21)
    clean = ["the river runs slowly", "A small house, near trees", "we walked for hours", "nothing else happened"]
    bad = ["you vile gronk", "such a snarfish idiot", "gronk and snarfish people"]
    rows = []
    for i in range(400):
        toxic = i % 5 == 0
        sentences = [rng.choice(clean) for _ in range(rng.randint(1, 4))]
        if toxic:
            sentences.insert(rng.randint(0, len(sentences)), rng.choice(bad))
        rows.append((i, rng.choice([". ", "! ", "\n", "?"]).join(sentences) + ".", int(toxic)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id long, quality int, toxic int")
    return rows, docs, labels


def words(text):
    return [(m.start(), m.end(), m.group()) for m in re.finditer(r"[^\W\d_]+", text.lower())]


def sentences(text):
    """Lists of words with no stop between them."""
    out, last = [], None
    for start, end, w in words(text):
        if last is None or any(c in text[last:start] for c in toxicity.STOPS):
            out.append([])
        out[-1].append((start, end, w))
        last = end
    return out


def logit(sentence, weight, bias):
    from chanloom.llm.strings import codepoints, mix, piece_hashes

    total = bias
    for _, _, w in sentence:
        codes, _ = codepoints([w])
        one = lambda n: piece_hashes(codes, np.array([0]), np.array([n]))
        features = [mix(one(len(w)))] + [mix(one(k) ^ np.uint64(k)) for k in toxicity.PREFIXES if len(w) >= k]
        total += sum(weight.get(int(f[0]), 0.0) for f in features)
    return total


def test_noisy_or_and_located_sentences(corpus):
    rows, docs, labels = corpus
    model = toxicity.train(docs, labels)
    weight = dict(zip(model[0].tolist(), model[1].tolist()))
    chance = lambda z: 1 / (1 + math.exp(-z))
    want, spans = {}, set()
    for i, text, _ in rows:
        keep = 1.0
        for s in sentences(text):
            p = chance(logit(s, weight, model[2]))
            keep *= 1 - p
            if p >= 0.5:
                spans.add((i, s[0][0], s[-1][1]))
        want[i] = 1 - keep
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all(math.isclose(got[i], want[i], abs_tol=1e-9) for i in want)
    found = {(r.doc_id, r.start, r.end) for r in toxicity.sentence_scores(docs, model).collect()}
    assert found == spans
    # the offending sentences are those with an offending word
    located = [rows[i][1][a:b].lower() for i, a, b in found]
    assert located and all("gronk" in x or "snarfish" in x for x in located)
    assert {i for i, _, _ in found} >= {i for i, _, toxic in rows if toxic}
