"""Lexical retrieval packing: BM25 neighbours fill a seed's window.

1. Every document is encoded once; its whole windows are sequences of their
   own, the rest (fewer tokens than a window) is stored with its ids.
2. Document frequencies of token ids (a table bounded by the vocabulary) and
   the mean length are computed over all rests.
3. Lexically close rests are placed together (``placed``) on narrow rows: a
   rest's heaviest terms.  A group above the bound is split by the score of
   its rests against pivots drawn from it, level by level, in cells of
   bounded size; close groups then share a shard.  Pivots, groups and shards
   stay in Spark.
4. A shard builds its inverted index with the corpus-wide BM25 weights
   (frequent terms as a matrix, the others as postings).  A seed document
   asks for its unused neighbours, best first; they fill the window, the last
   one is cut to fit, and what remains of it seeds the next window.

So a shard pads its last window only.  Cut pieces keep their document's
order; every id lies in exactly one piece.

Defined cases: a null or empty text is the one id END; texts are packed
whole, however long; repeated rows are documents of their own and spread over
shards like any others; ties in score go to the earlier row of the shard (by
document hash); an empty table gives an empty result; other columns of the
input play no part, whatever their names.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chanloom.llm.bpe import encode_texts
from chanloom.llm.common import groups_of, materialize, offsets, ranges, text_batches, text_of, tidy
from chanloom.operators.skew import salted_left_join

WINDOW = 2048
END = 1
K1, B = 1.2, 0.75
#: Documents of a group: a larger one is split.  A shard holds less than two.
SHARD_DOCS = 1_500
#: Pivots of one group (at most), and for each SHARD_DOCS of its documents.
PIVOTS, PIVOTS_EACH = 256, 4
#: Highest-weight tokens that stand for a rest when it is placed.
TERMS = 96
LEVELS = 5
#: Rests of a group that one task compares with its pivots.
CELL_DOCS = 8_192
#: Code points and rests whose numpy temporaries are held at once.
BATCH_CHARS = 400_000
BATCH_RESTS = 1_000
#: A term in more than 1 / FREQUENT of a shard's documents is a matrix column.
FREQUENT = 8
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _encoded(path: str, window: int):
    def run(batches):
        from pyspark import TaskContext

        rid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for a, b, part in text_batches(batch, "text", BATCH_CHARS):
                ids, at = encode_texts(part, path)
                docs = batch.column("doc_id").slice(a, b - a).to_pylist()
                uids = batch.column("uid").slice(a, b - a).to_pylist()
                rows = []
                for i, (doc, uid) in enumerate(zip(docs, uids)):
                    own = np.append(ids[at[i]: at[i + 1]], END).astype("<u4")
                    n = len(own)
                    for s in range(0, n - n % window, window):
                        rows.append((rid + len(rows), doc, uid, s, window, zlib.crc32(own[s: s + window].tobytes()), n, None))
                    if n % window:
                        rest = own[n - n % window:]
                        rows.append((rid + len(rows), doc, uid, n - len(rest), len(rest), 0, n, rest.tobytes() if rest.max() > 0xFFFF else rest.astype("<u2").tobytes()))
                rid += len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(),) * 7 + (pa.binary(),))],
                    ["rid", "doc_id", "uid", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    return run


def _ids(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype(np.int64)


def _term_counts(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, token, count) of every distinct token of each document."""
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    pairs, tf = np.unique(owner << 32 | np.concatenate(docs), return_counts=True)
    return pairs >> 32, pairs & 0xFFFFFFFF, tf


def _rests(batches):
    """Runs of rows of bounded size with their ids."""
    for batch in batches:
        for a in range(0, batch.num_rows, BATCH_RESTS):
            part = batch.slice(a, BATCH_RESTS)
            yield part, [_ids(raw, n) for raw, n in zip(part.column("ids").to_pylist(), part.column("length").to_pylist())]


def _frequencies(batches):
    total = np.zeros(0, np.int64)
    for _, docs in _rests(batches):
        n = np.bincount(_term_counts(docs)[1])
        if len(n) > len(total):
            total = np.append(total, np.zeros(len(n) - len(total), np.int64))
        total[: len(n)] += n
    found = np.flatnonzero(total)
    if len(found):
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], ["token", "df"])


def _weights(token: np.ndarray, tf: np.ndarray, size: np.ndarray, idf: np.ndarray, mean: float) -> np.ndarray:
    """BM25 weights of terms in documents of given sizes."""
    return idf[token] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / mean))


def _leading(idf_of, mean: float):
    """(rid, path, terms): the heaviest terms of every rest."""

    def run(batches):
        idf = idf_of()
        for part, docs in _rests(batches):
            doc, token, tf = _term_counts(docs)
            sizes = np.array([len(d) for d in docs])
            order = np.lexsort((token, -_weights(token, tf, sizes[doc], idf, mean), doc))
            first = offsets(np.bincount(doc, minlength=len(docs)))
            place = np.arange(len(doc)) - first[doc]
            kept = order[place < TERMS]
            ends = offsets(np.bincount(doc[kept], minlength=len(docs)))
            raw = token[kept].astype(_kind(idf)).tobytes()
            terms = pa.Array.from_buffers(pa.binary(), len(docs), [None, pa.py_buffer((_kind(idf).itemsize * ends).astype("<i4").tobytes()), pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays([part.column("rid"), pa.array(np.ones(len(docs), np.int64)), terms], ["rid", "path", "terms"])

    return run


def _kind(idf: np.ndarray) -> np.dtype:
    """How terms are stored."""
    return np.dtype("<u2" if len(idf) <= 1 << 16 else "<u4")


def _terms(column: pa.ChunkedArray, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """(document, token) of the terms of many rests."""
    raws = column.to_pylist()
    return np.repeat(np.arange(len(raws)), [len(r) // kind.itemsize for r in raws]), np.frombuffer(b"".join(raws), kind).astype(np.int64)


class Pivots:
    """Terms of a group's pivots.  Children are numbered along a chain of
    close pivots, so that neighbouring numbers are close too."""

    def __init__(self, column: pa.ChunkedArray, idf: np.ndarray):
        self.n, self.idf = len(column), idf
        owner, token = _terms(column, _kind(idf))
        order = np.argsort(token, kind="stable")
        self.owner = owner[order]
        self.tokens, first = np.unique(token[order], return_index=True)
        self.begin = np.append(first, len(token))
        close = self.scores(column)
        chain, left = [0], np.ones(self.n, bool)
        left[0] = False
        while left.any():
            chain.append(int(np.argmax(np.where(left, close[chain[-1]], -1.0))))
            left[chain[-1]] = False
        number = np.empty(self.n, np.int64)
        number[chain] = np.arange(self.n)
        self.owner = number[self.owner]

    def scores(self, column: pa.ChunkedArray) -> np.ndarray:
        doc, token = _terms(column, _kind(self.idf))
        at = np.minimum(np.searchsorted(self.tokens, token), len(self.tokens) - 1)
        known = self.tokens[at] == token
        doc, at = doc[known], at[known]
        n = self.begin[at + 1] - self.begin[at]
        cell = np.repeat(doc, n) * self.n + self.owner[ranges(self.begin[at], n)]
        return np.bincount(cell, weights=np.repeat(self.idf[self.tokens[at]], n), minlength=len(column) * self.n).reshape(len(column), self.n)


def _routed(idf_of):
    """The rests of a cell move to the child of their best pivot."""

    def run(rests: pa.Table, drawn: pa.Table) -> pa.Table:
        out = rests.select(["rid", "path", "terms"])
        if out.num_rows == 0 or drawn.num_rows < 2:
            return out
        pivots = Pivots(drawn.sort_by("p_h").column("p_terms"), idf_of())
        child = np.concatenate([pivots.scores(out.column("terms").slice(a, BATCH_RESTS)).argmax(axis=1) for a in range(0, out.num_rows, BATCH_RESTS)])
        path = out.column("path").to_numpy() * 512 + 1 + child
        return out.set_column(1, "path", pa.array(path, pa.int64()))

    return run


def _split(rows: DataFrame, large: DataFrame, level: int, idf_of) -> DataFrame:
    """``rows`` of the ``large`` groups (path, n) moved one level down.  A
    child's ``path`` is its group's times 512 plus its number."""
    hashed = F.xxhash64("rid", F.lit(100 + level))
    # in all about 4 pivots for 1,500 documents; equal rests are one pivot
    wanted = F.least(F.lit(PIVOTS), PIVOTS_EACH * F.ceil(F.col("n") / SHARD_DOCS))
    cells = F.ceil(F.col("n") / CELL_DOCS).cast("int")
    own = rows.join(large, "path").withColumns({"h": hashed, "wanted": wanted, "cells": cells})
    drawn = own.where(F.pmod("h", F.lit(1 << 30)) < (1 << 30) * F.least(F.lit(1.0), 2.0 * F.col("wanted") / F.col("n")))
    drawn = drawn.groupBy("path", "terms").agg(F.min("h").alias("h"), F.first("wanted").alias("wanted"), F.first("cells").alias("cells"))
    place = F.row_number().over(Window.partitionBy("path").orderBy("h"))
    drawn = drawn.withColumn("place", place).where(F.col("place") <= F.col("wanted"))
    pivots = drawn.select(F.col("path").alias("p_path"), F.col("terms").alias("p_terms"), F.col("h").alias("p_h"), F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("p_cell"))
    dealt = own.select("rid", "path", "terms", F.pmod(F.xxhash64("rid"), F.col("cells")).cast("int").alias("cell"))
    moved = dealt.groupBy("path", "cell").cogroup(pivots.groupBy("p_path", "p_cell")).applyInArrow(_routed(idf_of), "rid long, path long, terms binary")
    return rows.join(large, "path", "left_anti").unionByName(moved)


def _numbered(groups: DataFrame) -> DataFrame:
    """(path, first, parts) of groups (path, n): close groups follow each
    other in path order and share shards of SHARD_DOCS rests or a little
    more; a group that could not be split has ``parts`` shards of its own."""
    deep = F.col("path")
    for _ in range(LEVELS):
        deep = F.when(deep < 512 ** LEVELS, deep * 512).otherwise(deep)
    line = materialize(groups.withColumn("deep", deep).repartitionByRange("deep").withColumn("part__", F.spark_partition_id()), "groups")
    small = F.when(F.col("n") <= SHARD_DOCS, F.col("n")).otherwise(0)
    parts = F.when(F.col("n") <= SHARD_DOCS, 0).otherwise(F.ceil(F.col("n") / SHARD_DOCS))
    within = Window.partitionBy("part__").orderBy("deep").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition
    before = Window.orderBy("p__").rowsBetween(Window.unboundedPreceding, -1)
    sums = line.groupBy(F.col("part__").alias("p__")).agg(F.sum(small).alias("s"), F.sum(parts).alias("o"))
    sums = sums.select("p__", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("s", "o")])
    rows = line.join(sums, F.col("part__") == F.col("p__"))
    ahead = lambda c: F.coalesce(F.sum(c).over(within), F.lit(0))
    # shards of whole groups are even, those of cut groups odd
    shared = F.floor((F.col("s") + ahead(small)) / SHARD_DOCS) * 2
    alone = (F.col("o") + ahead(parts)) * 2 + 1
    return rows.select("path", F.when(parts > 0, alone).otherwise(shared).cast("long").alias("first"), F.greatest(parts, F.lit(1)).cast("long").alias("parts"))


def placed(rests: DataFrame, idf_of, mean: float) -> DataFrame:
    """(rid, shard) of every rest."""
    rows = materialize(rests.select("rid", "length", "ids").mapInArrow(tidy(_leading(idf_of, mean)), "rid long, path long, terms binary"), "leading")
    for level in range(LEVELS):
        # written, so that the planner knows how small it is
        large = materialize(rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SHARD_DOCS), "large")
        if large.isEmpty():
            break
        rows = materialize(_split(rows, large, level, idf_of), "placed")
    groups = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    where = salted_left_join(rows.select("rid", "path"), _numbered(groups), ["path"], [F.col("rid")])
    return where.select("rid", (F.col("first") + 2 * F.pmod(F.xxhash64("rid", F.lit(7)), F.col("parts"))).alias("shard"))


class Shard:
    """Inverted index of a shard's documents under the corpus-wide weights:
    frequent terms as the product of two matrices, the others as postings."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        n = len(docs)
        sizes = np.array([len(d) for d in docs], np.int64)
        owner, token, tf = _term_counts(docs)
        weight = _weights(token, tf, sizes[owner], idf, mean).astype(np.float32)
        tokens, at, held = np.unique(token, return_inverse=True, return_counts=True)
        at = at.ravel()
        often = np.flatnonzero(held > max(2, n // FREQUENT))
        column = np.full(len(tokens), -1)
        column[often] = np.arange(len(often))
        mine = column[at] >= 0
        matrix = np.zeros((n, len(often)), np.float32)
        matrix[owner[mine], column[at[mine]]] = weight[mine]
        self.close = (matrix > 0).astype(np.float32) @ matrix.T
        # postings of the others that two documents share
        mine = ~mine & (held[at] > 1)
        owner, at, weight = owner[mine], at[mine], weight[mine]
        self.begin = offsets(np.bincount(at, minlength=len(tokens)))
        order = np.argsort(at, kind="stable")
        self.owner, self.weight = owner[order], weight[order]
        self.first = offsets(np.bincount(owner, minlength=n))
        self.terms = at  # by document
        self.n = n

    def scores(self, doc: int) -> np.ndarray:
        """BM25 of all documents for a document's distinct terms."""
        at = self.terms[self.first[doc]: self.first[doc + 1]]
        posts = ranges(self.begin[at], self.begin[at + 1] - self.begin[at])
        return self.close[doc] + np.bincount(self.owner[posts], weights=self.weight[posts], minlength=self.n)


def fill_windows(docs: list[np.ndarray], index: Shard, window: int) -> list[tuple[int, int, int, int, int]]:
    """(document, begin, length, sequence, offset) of every piece of the
    shard's documents.  Seeds go in row order; a cut document's rest seeds
    the next window."""
    sizes = [len(d) for d in docs]
    used = np.zeros(len(docs), bool)
    out, sequence, nxt = [], 0, 0
    seed = None  # (document, begin)
    while True:
        if seed is None:
            while nxt < len(docs) and used[nxt]:
                nxt += 1
            if nxt == len(docs):
                return out
            seed = (nxt, 0)
            used[nxt] = True
        d, begin = seed
        seed = None
        at = sizes[d] - begin
        out.append((d, begin, at, sequence, 0))
        score = np.where(used, -1.0, index.scores(d)) if at < window else None
        while at < window:
            n = int(score.argmax())
            if used[n]:
                break  # all are taken
            used[n], score[n] = True, -1.0
            take = min(sizes[n], window - at)
            out.append((n, 0, take, sequence, at))
            at += take
            if take < sizes[n]:
                seed = (n, take)
        sequence += 1


def _filled(window: int, idf_of, mean: float):
    def run(batches):
        idf = idf_of()
        for group in groups_of(batches, "shard"):
            rows = group.select(["doc_id", "start", "length", "doc_tokens", "ids"]).to_pylist()
            docs = [_ids(r["ids"], r["length"]) for r in rows]
            base = group.column("shard")[0].as_py() << 32
            out = []
            for d, begin, n, sequence, at in fill_windows(docs, Shard(docs, idf, mean), window):
                r = rows[d]
                out.append((r["doc_id"], r["start"] + begin, n, zlib.crc32(docs[d][begin: begin + n].astype("<u4").tobytes()), r["doc_tokens"], base + sequence, at))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return run


def inverse_frequencies(rests: DataFrame) -> tuple[np.ndarray, float]:
    """BM25's idf by token id and the mean length, over all rests."""
    count, mean = rests.agg(F.count(F.lit(1)), F.avg("length")).first()
    df = rests.select("ids", "length").mapInArrow(tidy(_frequencies), "token long, df long").groupBy("token").agg(F.sum("df").alias("df"))
    # at most one row per token id of the vocabulary, whatever the corpus
    found = df.collect()
    idf = np.zeros(max((r.token for r in found), default=0) + 1)
    for r in found:
        idf[r.token] = math.log1p((count - r.df + 0.5) / (r.df + 0.5))
    return idf, mean or 1.0


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_of(docs, text).alias("text")).withColumn("uid", F.xxhash64("doc_id", "text"))
    pieces = rows.mapInArrow(tidy(_encoded(tokenizer, window)), "rid long, doc_id long, uid long, start long, length long, ids_crc32 long, doc_tokens long, ids binary")
    pieces = materialize(pieces, "pieces")
    rests = pieces.where("ids is not null")
    idf, mean = inverse_frequencies(rests)
    sent = docs.sparkSession.sparkContext.broadcast(idf)
    dealt = rests.join(placed(rests, lambda: sent.value, mean), "rid")
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "uid", "doc_id", "start", "rid").select("shard", "doc_id", "start", "length", "doc_tokens", "ids")
    filled = dealt.mapInArrow(tidy(_filled(window, lambda: sent.value, mean)), PIECE + ", sequence_id long, offset long")
    # a whole window is a sequence; its number is above those of all shards
    whole = pieces.where("ids is null").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("rid") + F.lit(1 << 62)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return filled.unionByName(whole)
