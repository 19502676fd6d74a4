"""Alignment of two tokenizers by interval coalescing.

Every token is a byte interval of space+text.  All A and B tokens of a batch
are lexsorted by start; where a start reaches the running maximum of the ends
before it (``maximum.accumulate``) a group ends.  Inside a group every A token
is linked with every B token.

1. Tasks tokenize and align chunks of whole documents.  Each document keeps
   its linked id pairs as numbers into the chunk's list of distinct pairs,
   with their multiplicity; the chunk's list carries how many of its
   documents hold each pair.  This is written once.
2. Pair counts are summed over chunks, and each A id's highest count is found.
   What is shuffled is one row a chunk and distinct pair, never one a link.
3. Counts go back to the chunks that asked for them, and are cogrouped with
   the chunk's documents.

A chunk holds at most ``CHUNK_CHARS`` code points (one document at least), so
every group of step 3 is bounded; a pair's rows are bounded by the number of
chunks, an A id's by B's vocabulary.

B is looked up by runs (spaces, then what is no space), which is exact if no
entry of B has a space after another character; other vocabularies are
encoded by whole texts.  A's pieces and B's runs are looked up by a 64-bit
hash, as in ``bpe``.

Defined cases: null and empty texts, and texts whose joined A or B bytes are
not the text's, have no tokens: zeros and ''.  Texts are aligned whole,
however long.  Rows that repeat are documents of their own.  An empty table
gives no rows.  Other columns of the input play no part, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chanloom.llm.bpe import Pieces, PieceTable, id_table, vocabulary
from chanloom.llm.common import materialize, offsets, ranges, text_batches, text_of, tidy, worker_cache

#: Code points handled at once, and held in a chunk.
BATCH_CHARS = 500_000
CHUNK_CHARS = 4_000_000
#: Links of one group that are expanded one by one; larger groups by distinct ids.
GROUP_LINKS = 1 << 16
BAD = np.uint32(0xFFFFFFFF)
SPACE = 0x20
ALIGNED = ("chunk string, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "which binary, times binary, pair array<long>, held array<int>")
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class PieceModel:
    """B: entries as bytes, and ids of a run of space+text."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        as_bytes = [bytes([int(n[3:5], 16)]) if model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        self.sizes = np.array([0 if model.is_control(i) or model.is_unknown(i) else len(b) for i, b in enumerate(as_bytes)], np.int64)
        #: whether a run's ids do not depend on what is around it
        self.by_run = not any(" " in n.replace("▁", " ").lstrip(" ") for i, n in enumerate(names) if not model.is_control(i))
        blank = model.piece_to_id("▁")

        def ids(run: str) -> list[int]:
            # the model itself puts the first space before a text
            found = model.encode(run[1:]) if len(run) > 1 else [blank]
            return found if b"".join(as_bytes[i] for i in found) == run.encode("utf-8", "surrogatepass") else [int(BAD)]

        self.table = PieceTable(ids, np.uint32)


def piece_model(path: str) -> PieceModel:
    cache = worker_cache()
    if not hasattr(cache, "piece_models"):
        cache.piece_models = {}
    if path not in cache.piece_models:
        cache.piece_models[path] = PieceModel(path)
    return cache.piece_models[path]


def _a_sizes(path: str) -> np.ndarray:
    cache = worker_cache()
    if not hasattr(cache, "a_sizes"):
        cache.a_sizes = {}
    if path not in cache.a_sizes:
        vocab = vocabulary(path)
        sizes = np.zeros(max(vocab.ranks.values()) + 1, np.int64)
        for raw, i in vocab.ranks.items():
            sizes[i] = len(raw)
        cache.a_sizes[path] = sizes
    return cache.a_sizes[path]


def token_ids(texts: list[str], a_path: str, b_path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of A and of B over all texts, and tokens of each text; texts
    without tokens (see above) have none on either side."""
    model, spaced = piece_model(b_path), [" " + t for t in texts]
    pieces = Pieces(spaced)
    codes, docs = pieces.codes, pieces.docs
    table = id_table(a_path)
    rows = pieces.look_up(table)
    a_each, a = table.length[rows], table.flat[ranges(table.begin[rows], table.length[rows])]
    n_a = np.diff(offsets(a_each)[pieces.doc_pieces])
    if model.by_run:
        head = codes == SPACE
        head[1:] &= codes[:-1] != SPACE
        head[docs[:-1]] = True
        starts = np.flatnonzero(head)
        ends = np.append(starts[1:], len(codes))
    else:
        starts, ends = docs[:-1], docs[1:]
    rows = pieces.look_up(model.table, starts, ends)
    b_each, b = model.table.length[rows], model.table.flat[ranges(model.table.begin[rows], model.table.length[rows])]
    n_b = np.diff(offsets(b_each)[np.searchsorted(starts, docs)])
    bad = np.add.reduceat(np.append(b == BAD, False).astype(np.int64), np.minimum(offsets(n_b)[:-1], len(b))) > 0
    bad[n_b == 0] = True
    bad |= np.diff(docs) == 1
    a, b = a[~np.repeat(bad, n_a)], b[~np.repeat(bad, n_b)]
    return a, np.where(bad, 0, n_a), b, np.where(bad, 0, n_b)


def coalesce(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers of all A tokens and all B tokens, given as byte sizes of
    two gapless covers of the same bytes."""
    a_end, b_end = np.cumsum(a_sizes), np.cumsum(b_sizes)
    start = np.concatenate([a_end - a_sizes, b_end - b_sizes])
    end = np.concatenate([a_end, b_end])
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    fresh = np.ones(len(order), np.int64)
    fresh[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(fresh) - 1
    return group[: len(a_sizes)], group[len(a_sizes):]


def linked(a: np.ndarray, a_group: np.ndarray, b: np.ndarray, b_group: np.ndarray, doc_of_group: np.ndarray, b_ids: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair, times): distinct linked id pairs of each document.
    A pair is a * b_ids + b."""
    groups = len(doc_of_group)
    n_a, n_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    at_a, at_b = offsets(n_a), offsets(n_b)
    large = n_a * n_b > GROUP_LINKS
    small_a = ~large[a_group]
    own, per = a_group[small_a], n_b[a_group[small_a]]
    pair = np.repeat(a[small_a].astype(np.int64) * b_ids, per) + b[ranges(at_b[own], per)]
    span = np.int64(b_ids) << 20
    key, times = np.unique(np.repeat(doc_of_group[own], per) * span + pair, return_counts=True)
    keys, counts = [key], [times.astype(np.int64)]
    for g in np.flatnonzero(large).tolist():
        x, nx = np.unique(a[at_a[g]: at_a[g + 1]].astype(np.int64), return_counts=True)
        y, ny = np.unique(b[at_b[g]: at_b[g + 1]].astype(np.int64), return_counts=True)
        keys.append(doc_of_group[g] * span + (x[:, None] * b_ids + y[None, :]).ravel())
        counts.append((nx[:, None] * ny[None, :]).ravel())
    if len(keys) > 1:
        key, which = np.unique(np.concatenate(keys), return_inverse=True)
        times = np.zeros(len(key), np.int64)
        np.add.at(times, which.ravel(), np.concatenate(counts))
    return key // span, key % span, times.astype(np.int64)


def _written(a: np.ndarray, a_group: np.ndarray, b: np.ndarray, b_group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The groups of all documents as text, ``a1,a2|b1;`` and so on: bytes,
    and the place in them where each group starts."""
    groups = int(a_group[-1]) + 1
    ids = np.empty(len(a) + len(b), np.int64)
    mark = np.full(len(ids), ord(","), np.uint8)
    at_a = offsets(np.bincount(a_group, minlength=groups))
    at_b = offsets(np.bincount(b_group, minlength=groups))
    ids[np.arange(len(a)) + at_b[a_group]] = a
    ids[np.arange(len(b)) + at_a[b_group + 1]] = b
    mark[at_a[1:] + at_b[:-1] - 1] = ord("|")
    mark[at_a[1:] + at_b[1:] - 1] = ord(";")
    width = len(str(int(ids.max())))
    digits = np.zeros((len(ids), width + 1), np.uint8)
    left = ids
    for k in range(width - 1, -1, -1):
        digits[:, k] = left % 10 + 48
        left = left // 10
    digits[:, width] = mark
    shown = np.ones(digits.shape, bool)
    for k in range(width - 1):
        shown[:, k] = ids >= 10 ** (width - 1 - k)
    place = offsets(shown.sum(axis=1))
    return digits[shown], place[at_a + at_b]


def align(texts: list[str], a_path: str, b_path: str) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
    """Per text (n_a, n_b, n_groups, n_links, groups_sha256), and the distinct
    linked pairs as (text number, pair, times)."""
    a, n_a, b, n_b = token_ids(texts, a_path, b_path)
    none = np.zeros(0, np.int64)
    if not len(a):
        return [(0, 0, 0, 0, "")] * len(texts), none, none, none
    model = piece_model(b_path)
    a_group, b_group = coalesce(_a_sizes(a_path)[a], model.sizes[b])
    at_a = offsets(n_a)
    # documents are whole covers, so groups never cross them
    first = np.append(a_group, a_group[-1] + 1)[at_a]
    doc_of_group = np.repeat(np.arange(len(texts)), np.diff(first))
    doc, pair, times = linked(a, a_group, b, b_group, doc_of_group, len(model.sizes))
    n_links = np.bincount(doc, weights=times, minlength=len(texts)).astype(np.int64)
    written, place = _written(a, a_group, b, b_group)
    rows = []
    for i in range(len(texts)):
        if n_a[i]:
            raw = written[place[first[i]]: place[first[i + 1]] - 1].tobytes()
            rows.append((int(n_a[i]), int(n_b[i]), int(first[i + 1] - first[i]), int(n_links[i]), hashlib.sha256(raw).hexdigest()))
        else:
            rows.append((0, 0, 0, 0, ""))
    return rows, doc, pair, times


def _packed(x: np.ndarray) -> bytes:
    """Unsigned integers in the narrowest of three widths; the first byte names it."""
    top = int(x.max()) if len(x) else 0
    kind = "<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u8"
    return kind[2].encode() + x.astype(kind).tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{chr(raw[0])}", offset=1).astype(np.int64)


def _aligned(a_path: str, b_path: str):
    def chunk_rows(name: str, ids: list, rows: list, found: list):
        docs = offsets([n for n, *_ in found])
        doc = np.concatenate([d + docs[i] for i, (_, d, _, _) in enumerate(found)])
        pair, which, held = np.unique(np.concatenate([p for _, _, p, _ in found]), return_inverse=True, return_counts=True)
        which, times = which.ravel(), np.concatenate([t for *_, t in found])
        at = np.searchsorted(doc, np.arange(len(ids) + 1))
        cells = [(_packed(which[a:b]), _packed(times[a:b])) for a, b in zip(at[:-1], at[1:])]
        n = len(ids)
        schema = ["chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "which", "times", "pair", "held"]
        stats = [pa.array(c, pa.int64()) for c in list(zip(*rows))[:4]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * n), pa.array(ids, pa.int64()), *stats, pa.array([r[4] for r in rows]), pa.array([c[0] for c in cells], pa.binary()),
             pa.array([c[1] for c in cells], pa.binary()), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int32()))], schema)
        if len(pair):
            one = [pa.nulls(1, t) for t in (pa.int64(),) * 5 + (pa.string(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array([name]), *one, pa.array([pair], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.int32()))], schema)

    def run(batches):
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        ids, rows, found, chars = [], [], [], 0
        for batch in batches:
            for a, b, part in text_batches(batch, "text", BATCH_CHARS):
                size = sum(map(len, part))
                if ids and chars + size > CHUNK_CHARS:
                    yield from chunk_rows(f"{task}-{number}", ids, rows, found)
                    ids, rows, found, chars, number = [], [], [], 0, number + 1
                own, doc, pair, times = align(part, a_path, b_path)
                ids += batch.column("doc_id").slice(a, b - a).to_pylist()
                rows += own
                found.append((len(part), doc, pair, times))
                chars += size
        if ids:
            yield from chunk_rows(f"{task}-{number}", ids, rows, found)

    return run


def _answered(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Links of a chunk's documents under the corpus-wide counts."""
    size = answers.num_rows
    place = answers.column("place").to_numpy()
    count, best = np.zeros(size, np.int64), np.zeros(size, bool)
    count[place] = answers.column("n").to_numpy()
    best[place] = answers.column("best").to_numpy(zero_copy_only=False)
    n_best, total = [], []
    for which, times in zip(docs.column("which").to_pylist(), docs.column("times").to_pylist()):
        at, many = _unpacked(which), _unpacked(times)
        n_best.append(int(many[best[at]].sum()))
        total.append(int((many * count[at]).sum()))
    col = docs.column
    return pa.table([col("doc_id"), col("n_a"), col("n_b"), col("n_groups"), col("n_links"), pa.array(n_best, pa.int64()), pa.array(total, pa.int64()), col("groups_sha256")],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def pair_counts(asked: DataFrame) -> DataFrame:
    """(pair, n, best) from (pair, held, a): documents that hold a pair, and
    whether no pair of the same A id is held by more."""
    counts = asked.groupBy("pair", "a").agg(F.sum("held").alias("n"))
    # at most one row a B id in each window
    top = F.max("n").over(Window.partitionBy("a"))
    return counts.select("pair", "n", (F.col("n") == top).alias("best"))


def aligned_documents(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_of(docs, text).alias("text"))
    aligned = materialize(rows.mapInArrow(tidy(_aligned(a_path, b_path)), ALIGNED), "aligned")
    lists = aligned.where(F.col("pair").isNotNull()).select("chunk", F.posexplode(F.arrays_zip("pair", "held")).alias("place", "p"))
    b_ids = len(piece_model(b_path).sizes)
    asked = lists.select("chunk", "place", F.col("p.pair").alias("pair"), F.col("p.held").alias("held"), F.floor(F.col("p.pair") / b_ids).alias("a"))
    answers = asked.select("chunk", "place", "pair").join(pair_counts(asked), "pair").select("chunk", "place", "n", "best")
    own = aligned.where(F.col("groups_sha256").isNotNull()).drop("pair", "held").withColumnRenamed("chunk", "own_chunk")
    return own.groupBy("own_chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_answered, RESULT)
