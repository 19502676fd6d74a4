"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's probability is logistic in
its tokens' weights; the document's is their noisy-or, 1 - prod(1 - p).
Document labels alone train the weights; sentence scores then locate the
offending sentences (``sentence_scores``).

A token's features are the lower-case word and its first 4, 5 and 6
letters.  Document frequencies by label of all features are counted over all
labelled training rows, and every telling one is kept.  The weights are fitted
on a sample of at most about ``SAMPLE`` rows of each label (chosen by hash,
weighted back to all rows); a feature that no sampled row has takes its weight
from the counts over all rows.

Defined cases: a null or empty text, or one without letters, is one empty
sentence; repeated rows score alike; without labels of both kinds every score
is the share of label 1 (0 without labels); a row is held out when
crc32(doc_id as text) mod 4 is 2, and a null doc_id is not.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanloom.llm.bpe import LETTER, char_classes
from chanloom.llm.common import materialize, offsets, ranges, text_batches, text_of
from chanloom.llm.strings import codepoints, mix, piece_hashes, word_spans

#: Labelled ids are broadcast up to this number of rows, joined by a shuffle beyond.
BROADCAST_IDS = 2_000_000
PREFIXES = (4, 5, 6)
SAMPLE = 6_000
LEAST_POSITIVE = 4
#: A feature must be this much (log ratio) likelier in label 1, or have this
#: G statistic (chance 1 %).
TELLING = 0.7
SIGNIFICANT = 6.63
THRESHOLD = 0.3
STOPS = ".!?\n"
BATCH_CHARS = 1_000_000
#: Features that a map task counts before it sends them on.
COMBINE = 1_000_000


def held_out(key: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


class Sentences:
    """Tokens of a batch: distinct words with their feature hashes, and the
    sentence and document of every token and of every sentence."""

    def __init__(self, texts: list[str]):
        lower = [t.lower() for t in texts]
        codes, docs = codepoints(lower)
        stop = np.isin(codes, [ord(c) for c in STOPS])
        letter = char_classes()[codes] == LETTER
        self.starts, self.ends, self.doc = word_spans(~letter, docs)
        # a sentence: tokens of a document with no stop between them
        stops = np.cumsum(stop)
        n = len(self.starts)
        begins = np.ones(n, bool)
        if n:
            begins[1:] = (self.doc[1:] != self.doc[:-1]) | (stops[self.starts[1:]] != stops[self.starts[:-1]])
        self.sentence = np.cumsum(begins) - 1
        self.heads = np.flatnonzero(begins)
        self.sentence_doc = self.doc[self.heads]
        words = piece_hashes(codes, self.starts, self.ends) if n else np.zeros(0, np.uint64)
        self.words, first, which = np.unique(words, return_index=True, return_inverse=True)
        self.which = which.ravel()
        s, length = self.starts[first], (self.ends - self.starts)[first]
        kinds, owners = [mix(self.words)], [np.arange(len(first))]
        for k in PREFIXES:
            long = np.flatnonzero(length >= k)
            kinds.append(mix(piece_hashes(codes, s[long], s[long] + k) ^ np.uint64(k)) if len(long) else np.zeros(0, np.uint64))
            owners.append(long)
        self.features, self.owner = np.concatenate(kinds), np.concatenate(owners)
        self.head_chars, self.tail_chars = self.starts[self.heads], self.ends[np.append(self.heads[1:], n) - 1] if n else self.starts
        self.docs = docs


def _counted(batches):
    h, pos, neg = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def out():
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(pos), pa.array(neg)], ["h", "pos", "neg"])

    for batch in batches:
        labels = batch.column("toxic").to_numpy(zero_copy_only=False)
        for a, _, part in text_batches(batch, "text", BATCH_CHARS):
            s = Sentences(part)
            if not len(s.which):
                continue
            # (document, feature) pairs, each once
            pair = np.unique(s.doc * len(s.words) + s.which)
            doc, word = pair // len(s.words), pair % len(s.words)
            order = np.argsort(s.owner, kind="stable")
            by_word = offsets(np.bincount(s.owner, minlength=len(s.words)))
            n = np.diff(by_word)[word]
            feature = order[ranges(by_word[word], n)]
            distinct, number = np.unique(s.features, return_inverse=True)
            pairs = np.unique(np.repeat(doc, n) * len(distinct) + number.ravel()[feature])
            toxic = labels[a + pairs // len(distinct)] == 1
            p = np.bincount(pairs % len(distinct), weights=toxic, minlength=len(distinct)).astype(np.int64)
            q = np.bincount(pairs % len(distinct), weights=~toxic, minlength=len(distinct)).astype(np.int64)
            h, which = np.unique(np.concatenate([h, distinct]), return_inverse=True)
            pos = np.bincount(which.ravel(), weights=np.concatenate([pos, p])).astype(np.int64)
            neg = np.bincount(which.ravel(), weights=np.concatenate([neg, q])).astype(np.int64)
            if len(h) > COMBINE:
                yield out()
                h, pos, neg = h[:0], pos[:0], neg[:0]
    if len(h):
        yield out()


def _bags(feature_hashes: np.ndarray):
    """Per document: kept features of its sentences, as int32 ids with -1
    after each sentence that has any, and the number of other sentences."""

    def run(batches):
        for batch in batches:
            for a, b, part in text_batches(batch, "text", BATCH_CHARS):
                s = Sentences(part)
                at = np.minimum(np.searchsorted(feature_hashes, s.features), len(feature_hashes) - 1)
                known = feature_hashes[at] == s.features
                order = np.argsort(s.owner[known], kind="stable")
                ids = at[known][order]
                by_word = offsets(np.bincount(s.owner[known], minlength=max(1, len(s.words))))
                bags, empty = [], []
                tokens = offsets(np.bincount(s.doc, minlength=len(part)))
                for d in range(len(part)):
                    mine = slice(tokens[d], tokens[d + 1])
                    w, sent = s.which[mine], s.sentence[mine]
                    n = np.diff(by_word)[w] if len(w) else np.zeros(0, np.int64)
                    own = ids[ranges(by_word[w], n)] if len(w) else np.zeros(0, np.int64)
                    of = np.repeat(sent, n)
                    ends = np.flatnonzero(np.diff(of, append=-1)) + 1 if len(of) else np.zeros(0, np.int64)
                    bags.append(np.insert(own, ends, -1).astype(np.int32).tobytes())
                    empty.append(max(len(np.unique(sent)), 1) - len(ends))
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([rows.column("toxic"), pa.array(bags, pa.binary()), pa.array(empty, pa.int64())], ["toxic", "bag", "empty"])

    return run


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def fit_noisy_or(bags: list[np.ndarray], empty: np.ndarray, label: np.ndarray, weight: np.ndarray, features: int, steps: int = 300, rate: float = 0.08, l2: float = 2e-4):
    """Weights and bias by Adam on the weighted log loss of documents.

    With u = sum of softplus(z) over a document's sentences, its noisy-or is
    1 - exp(-u), so the loss is u for label 0 and -log(1 - exp(-u)) for 1."""
    ids = np.concatenate([*bags, np.zeros(0, np.int32)])
    doc_of = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    stop = ids < 0
    sentence_doc = doc_of[stop]
    sentence = (np.cumsum(stop) - stop)[~stop]
    ids = ids[~stop]
    n = int(stop.sum())
    w, b = np.zeros(features), -4.0
    m, v = np.zeros(features + 1), np.zeros(features + 1)
    weight = weight / weight.sum()
    for step in range(1, steps + 1):
        z = b + np.bincount(sentence, weights=w[ids], minlength=n)
        u = np.bincount(sentence_doc, weights=_softplus(z), minlength=len(bags)) + empty * _softplus(b)
        slope = np.where(label == 1, -1.0 / np.expm1(np.clip(u, 1e-9, 500)), 1.0) * weight
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        dz = slope[sentence_doc] * p
        g = np.append(np.bincount(ids, weights=dz[sentence], minlength=features) + l2 * w / max(1, features) ** 0.5,
                      dz.sum() + (slope * empty).sum() / (1 + np.exp(-b)))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-10)
        w, b = w - move[:-1], b - move[-1]
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[np.ndarray, np.ndarray, float]:
    """(feature hashes sorted, their weights, bias); without any feature the
    third is every document's score."""
    marks = labels.select(F.col("doc_id").alias("id__"), F.col("toxic").cast("int").alias("toxic")).where("id__ is not null and toxic is not null")
    marks = marks.where(~held_out(F.col("id__"))).groupBy("id__").agg(F.max("toxic").alias("toxic"))
    total = {r.toxic: r["count"] for r in marks.groupBy("toxic").count().collect()}
    n_pos, n_neg = total.get(1, 0), total.get(0, 0)
    nothing = np.zeros(0, np.uint64), np.zeros(0)
    share = n_pos / max(1, n_pos + n_neg)
    if not n_pos or not n_neg:
        return *nothing, float(share)
    small = n_pos + n_neg <= BROADCAST_IDS
    rows = docs.select(F.col(key).alias("key__"), text_of(docs, text).alias("text"))
    rows = rows.join(F.broadcast(marks) if small else marks, F.col("key__") == F.col("id__"))
    counts = rows.select("text", "toxic").mapInArrow(_counted, "h long, pos long, neg long").groupBy("h").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    ratio = F.log((F.col("pos") + 0.5) / F.lit(n_pos + 1.0)) - F.log((F.col("neg") + 0.5) / F.lit(n_neg + 1.0))
    of = lambda seen, n: F.when(seen > 0, seen * F.log(seen * (n_pos + n_neg) / ((F.col("pos") + F.col("neg")) * n))).otherwise(0.0)
    missing = lambda seen, n: F.when(seen < n, (n - seen) * F.log((n - seen) * (n_pos + n_neg) / ((n_pos + n_neg - F.col("pos") - F.col("neg")) * n))).otherwise(0.0)
    g = 2 * (of(F.col("pos"), n_pos) + of(F.col("neg"), n_neg) + missing(F.col("pos"), n_pos) + missing(F.col("neg"), n_neg))
    telling = ((F.col("pos") >= LEAST_POSITIVE) & (ratio >= TELLING)) | ((ratio > 0) & (g >= SIGNIFICANT))
    top = counts.withColumn("ratio", ratio).where(telling).select("h", "ratio").toArrow()
    hashes = top.column("h").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    hashes, ratios = hashes[order], top.column("ratio").to_numpy()[order]
    if not len(hashes):
        return *nothing, float(share)
    chance = F.when(F.col("toxic") == 1, min(1.0, SAMPLE / n_pos)).otherwise(min(1.0, SAMPLE / n_neg))
    drawn = F.pmod(F.xxhash64("key__", F.lit(8)), F.lit(1 << 30)) < chance * (1 << 30)
    sample = rows.where(drawn).select("text", "toxic").mapInArrow(_bags(hashes), "toxic int, bag binary, empty long").toArrow()
    label = sample.column("toxic").to_numpy()
    bags = [np.frombuffer(x, np.int32) for x in sample.column("bag").to_pylist()]
    weight = np.where(label == 1, n_pos / max(1, (label == 1).sum()), n_neg / max(1, (label != 1).sum()))
    w, b = fit_noisy_or(bags, sample.column("empty").to_numpy().astype(float), label, weight, len(hashes))
    unseen = np.ones(len(hashes), bool)
    for bag in bags:
        unseen[bag[bag >= 0]] = False
    # a word's own feature and its prefixes share its weight
    return hashes, np.where(unseen, ratios / (1 + len(PREFIXES)), w), b


def _sentence_logits(s: Sentences, hashes: np.ndarray, w: np.ndarray, b: float) -> np.ndarray:
    value = np.zeros(len(s.words))
    if len(hashes) and len(s.features):
        at = np.minimum(np.searchsorted(hashes, s.features), len(hashes) - 1)
        known = hashes[at] == s.features
        value = np.bincount(s.owner[known], weights=w[at[known]], minlength=len(s.words))
    if not len(s.heads):
        return np.zeros(0)
    return b + np.add.reduceat(value[s.which], s.heads)


def document_scores(texts: list[str], hashes: np.ndarray, w: np.ndarray, b: float) -> np.ndarray:
    if not len(hashes):
        return np.full(len(texts), b)
    s = Sentences(texts)
    u = np.bincount(s.sentence_doc, weights=_softplus(_sentence_logits(s, hashes, w, b)), minlength=len(texts))
    none = np.bincount(s.sentence_doc, minlength=len(texts)) == 0
    return -np.expm1(-np.where(none, _softplus(b), u))


def score(docs: DataFrame, model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the noisy-or score of every document."""
    hashes, w, b = model

    def run(batches):
        for batch in batches:
            for a, n, part in text_batches(batch, "text", BATCH_CHARS):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, n - a), pa.array(document_scores(part, hashes, w, b))], ["doc_id", "score"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), text_of(docs, text).alias("text")).mapInArrow(run, "doc_id long, score double")


def sentence_scores(docs: DataFrame, model, least: float = 0.5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Offending sentences: doc_id, start, end (code points from the first to
    the last letter), probability of at least ``least``."""
    hashes, w, b = model

    def run(batches):
        for batch in batches:
            for a, _, part in text_batches(batch, "text", BATCH_CHARS):
                s = Sentences(part)
                if not len(hashes):
                    continue
                p = np.exp(-_softplus(-_sentence_logits(s, hashes, w, b)))
                hit = np.flatnonzero(p >= least)
                base = s.docs[:-1][s.sentence_doc[hit]]
                ids = batch.column("doc_id").take(pa.array(a + s.sentence_doc[hit]))
                yield pa.RecordBatch.from_arrays([ids, pa.array(s.head_chars[hit] - base), pa.array(s.tail_chars[hit] - base), pa.array(p[hit])], ["doc_id", "start", "end", "probability"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_of(docs, text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, start long, end long, probability double")


def toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = score(docs, train(docs, labels, key, text), key, text)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
