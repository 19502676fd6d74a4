"""Hard negatives by a vertical scan of vectors (BOND).

Vectors are stored in blocks of columns.  For each anchor a block's columns
are read in descending order of the anchor's magnitudes; after every few
columns the least and most that the others can still add (from each column's
minimum and maximum) bound every candidate's score, and candidates that can
no longer be in the answer leave the bitmap.  What remains after the last
column has its exact score.

1. Rows become blocks of at most ``BLOCK_ROWS`` where they are read; anchors
   are rows of their own.  Both are written once.
2. Blocks and anchors meet in cells of a grid (``CELL_ROWS`` rows by
   ``CELL_ANCHORS`` anchors), a cogroup by cell: every anchor meets every
   block once, in bounded tasks, whatever a label's share is.
3. First pass: the best rows of the anchor's label, a few a cell, ranked per
   anchor.  Second pass: the best rows of other labels in each positive's
   score window, likewise.  Bounds carry over from block to block of a cell.

Only two row counts come to the driver.

Defined cases: rows with a null label, a null vector or a null or non-finite
component take no part.  A vec_id that repeats: every row counts for itself,
and "other rows" are those of another vec_id.  A null vec_id is no anchor,
keeps its label, and comes last among ties.  Vectors of different lengths are
not compared; empty vectors have score 0.  Components are held within
+-``LARGEST``, so that scores fit in a long.  An empty table, and anchors
without positives or negatives, give no rows.  Other columns play no part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chanloom.llm.common import materialize, offsets, tidy

ANCHOR_EVERY = 100
POSITIVES, NEGATIVES = 5, 10
#: A negative's score is 30 % to 90 % of the positive's.
LOW, HIGH = 30, 90
SCALE = 256
LARGEST = float(1 << 23)
BLOCK_ROWS = 4_096
CELL_ROWS, CELL_ANCHORS = 8_192, 8_192
#: Components handled at once.
VALUES = 1 << 20
#: Columns read between two looks at the bounds.
STEP = 8
EXACT = float(1 << 53)
BLOCKS = "block string, dims int, n int, ids binary, no_id binary, labels binary, cols binary"
ANCHORS = "uid long, anchor_id long, label int, dims int, vec binary"


def quantized(batch: pa.RecordBatch):
    """(vec_id column, null marks, labels, dims, matrix) of a batch's rows
    that take part, one item per vector length."""
    lists = batch.column("embedding")
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null: NaN
    at = offsets(sizes)
    ids = batch.column("vec_id")
    no_id = ids.is_null().to_numpy(zero_copy_only=False)
    ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
    labels = batch.column("label").to_numpy(zero_copy_only=False)
    for dims in np.unique(sizes).tolist():
        every = np.flatnonzero(sizes == dims)
        step = max(1, VALUES // max(1, dims))
        for s in range(0, len(every), step):
            rows = every[s: s + step]
            values = flat[at[rows][:, None] + np.arange(dims)] if dims else np.zeros((len(rows), 0))
            fine = np.isfinite(values).all(axis=1)
            rows, values = rows[fine], values[fine]
            if len(rows):
                yield ids[rows], no_id[rows], labels[rows], dims, np.clip(np.floor(SCALE * values), -LARGEST, LARGEST)


def _blocks(batches):
    from pyspark import TaskContext

    task, made = TaskContext.get().partitionId(), 0
    held: dict[int, list] = {}

    def block(dims: int, parts: list):
        ids, no_id, labels, values = (np.concatenate(x) for x in zip(*parts))
        kind = np.int16 if not values.size or np.abs(values).max() < 1 << 15 else np.int32
        cells = [f"{task}-{made}", dims, len(ids), ids.astype("<i8").tobytes(), no_id.tobytes(), labels.astype("<i4").tobytes(),
                 np.ascontiguousarray(values.T).astype(kind).tobytes()]
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], ["block", "dims", "n", "ids", "no_id", "labels", "cols"])

    for batch in batches:
        for ids, no_id, labels, dims, values in quantized(batch):
            for s in range(0, len(ids), BLOCK_ROWS):
                part = slice(s, s + BLOCK_ROWS)
                own = held.setdefault(dims, [])
                own.append((ids[part], no_id[part], labels[part], values[part]))
                if sum(len(p[0]) for p in own) >= BLOCK_ROWS:
                    yield block(dims, held.pop(dims))
                    made += 1
    for dims, own in held.items():
        yield block(dims, own)
        made += 1


def _anchor_rows(batches):
    from pyspark import TaskContext

    uid = TaskContext.get().partitionId() << 33
    for batch in batches:
        for ids, _, labels, dims, values in quantized(batch):
            n = len(ids)
            raw = [v.astype("<i4").tobytes() for v in values]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(uid, uid + n)), pa.array(ids, pa.int64()), pa.array(labels, pa.int32()), pa.array([dims] * n, pa.int32()), pa.array(raw, pa.binary())],
                                             ["uid", "anchor_id", "label", "dims", "vec"])
            uid += n


class Block:
    """Columns of some rows, with their extremes."""

    def __init__(self, row: dict):
        n, dims = row["n"], row["dims"]
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.no_id = np.frombuffer(row["no_id"], np.bool_)
        self.labels = np.frombuffer(row["labels"], "<i4")
        kind = np.int16 if len(row["cols"]) == 2 * n * dims else np.int32
        self.cols = np.frombuffer(row["cols"], kind).reshape(dims, n).astype(np.float64)
        self.dims = dims
        self.least, self.most = (self.cols.min(axis=1), self.cols.max(axis=1)) if dims else (np.zeros(0), np.zeros(0))
        self._whole = None

    def whole(self) -> np.ndarray:
        if self._whole is None:
            self._whole = self.cols.astype(np.int64)
        return self._whole


def scan(block: Block, anchor: np.ndarray, live: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``live`` that survive, and their exact scores.  ``keep(least,
    most)`` marks the candidates that may still be in the answer."""
    order = np.argsort(-np.abs(anchor), kind="stable")
    reach = np.maximum(anchor * block.least, anchor * block.most)
    floor = np.minimum(anchor * block.least, anchor * block.most)
    top = float(np.maximum(np.abs(reach), np.abs(floor)).sum())
    exact = top < EXACT
    slack = 0 if exact else top * 1e-12  # bounds of longer sums are rounded
    cols, a = (block.cols, anchor) if exact else (block.whole(), anchor.astype(np.int64))
    score = np.zeros(len(live), cols.dtype)
    every = len(live) == len(block.ids)
    for s in range(0, block.dims, STEP):
        part, rest = order[s: s + STEP], order[s + STEP:]
        score = score + a[part] @ (cols[part] if every else cols[np.ix_(part, live)])
        fit = keep(score + (floor[rest].sum() - slack), score + (reach[rest].sum() + slack)) if len(rest) else keep(score, score)
        if not fit.all():
            live, score, every = live[fit], score[fit], False
            if not len(live):
                break
    return live, score.astype(np.int64)


def _kth(values: np.ndarray, k: int) -> float:
    """The k-th largest value (fewer: minus infinity)."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -math.inf


class Best:
    """The first k rows met so far: higher scores, then smaller ids."""

    def __init__(self, k: int):
        self.k = k
        self.rows: list[tuple] = []  # (-score, no id, id)

    def floor(self) -> float:
        return -self.rows[-1][0] if len(self.rows) == self.k else -math.inf

    def add(self, block: Block, live: np.ndarray, score: np.ndarray) -> None:
        if len(live) > self.k:
            first = np.lexsort((block.ids[live], block.no_id[live], -score))[: self.k]
            live, score = live[first], score[first]
        new = zip((-score).tolist(), block.no_id[live].tolist(), block.ids[live].tolist())
        self.rows = sorted([*self.rows, *new])[: self.k]


def _cells(blocks: pa.Table, anchors: pa.Table):
    """Each block with the anchors of its length, decoded once."""
    own = anchors.to_pylist()
    by_dims: dict[int, list] = {}
    for a in own:
        a["vec"] = np.frombuffer(a["vec"], "<i4").astype(np.float64)
        by_dims.setdefault(a["dims"], []).append(a)
    for i in range(blocks.num_rows):
        block = Block(blocks.slice(i, 1).to_pylist()[0])
        for a in by_dims.get(block.dims, ()):
            yield block, a


def _positives(anchors: pa.Table, blocks: pa.Table) -> pa.Table:
    best: dict[int, Best] = {}
    for block, a in _cells(blocks, anchors):
        own = best.setdefault(a["uid"], Best(POSITIVES))
        live = np.flatnonzero((block.labels == a["label"]) & (block.no_id | (block.ids != a["anchor_id"])))
        if not len(live):
            continue
        known = own.floor()
        own.add(block, *scan(block, a["vec"], live, lambda least, most: most >= max(known, _kth(least, POSITIVES))))
    rows = [(uid, -s, None if none else i) for uid, own in best.items() for s, none, i in own.rows]
    return _table(rows, [("uid", pa.int64()), ("score", pa.int64()), ("positive_id", pa.int64())])


def _negatives(anchors: pa.Table, blocks: pa.Table) -> pa.Table:
    best: dict[int, list] = {}
    for block, a in _cells(blocks, anchors):
        own = best.get(a["uid"])
        if own is None:
            # (place, positive, lowest, highest, first ones)
            own = best[a["uid"]] = [(p["place"], p, -(-LOW * p["score"] // 100), HIGH * p["score"] // 100, Best(NEGATIVES)) for p in a["positives"]]
            own[:] = [w for w in own if w[2] <= w[3]]
        live = np.flatnonzero(block.labels != a["label"])
        if not own or not len(live):
            continue

        def keep(least, most):
            fit = np.zeros(len(least), bool)
            for _, _, low, high, first in own:
                sure = least[(least >= low) & (most <= high)]
                fit |= (most >= max(low, first.floor(), _kth(sure, NEGATIVES))) & (least <= high)
            return fit

        live, score = scan(block, a["vec"], live, keep)
        for _, _, low, high, first in own:
            inside = (score >= low) & (score <= high)
            first.add(block, live[inside], score[inside])
    ids = {a["uid"]: a["anchor_id"] for a in anchors.select(["uid", "anchor_id"]).to_pylist()}
    rows = [(uid, ids[uid], place, p["positive_id"], p["score"], None if none else i, -s)
            for uid, own in best.items() for place, p, _, _, first in own for s, none, i in first.rows]
    return _table(rows, [("uid", pa.int64()), ("anchor_id", pa.int64()), ("place", pa.int32()), ("positive_id", pa.int64()),
                         ("positive_score", pa.int64()), ("negative_id", pa.int64()), ("negative_score", pa.int64())])


def _table(rows: list[tuple], kinds: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.table([pa.array(c, k) for c, (_, k) in zip(columns, kinds)], names=[n for n, _ in kinds])


def _grid(anchors: DataFrame, blocks: DataFrame, down: int, across: int, run, schema: str) -> DataFrame:
    """``run`` on every cell of ``down`` parts of the anchors and ``across``
    parts of the blocks."""
    left = anchors.withColumns({"a_down": F.pmod(F.xxhash64("uid"), F.lit(down)), "a_across": F.explode(F.sequence(F.lit(0), F.lit(across - 1)))})
    right = blocks.withColumns({"b_across": F.pmod(F.xxhash64("block"), F.lit(across)), "b_down": F.explode(F.sequence(F.lit(0), F.lit(down - 1)))})
    left = left.withColumns({"a_down": F.col("a_down").cast("int"), "a_across": F.col("a_across").cast("int")})
    right = right.withColumns({"b_down": F.col("b_down").cast("int"), "b_across": F.col("b_across").cast("int")})
    return left.groupBy("a_down", "a_across").cogroup(right.groupBy("b_down", "b_across")).applyInArrow(run, schema)


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and
    negative_score for (vec_id, label, embedding) rows."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<float>").alias("embedding"))
    rows = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).withColumn("label", label.cast("int"))
    blocks = materialize(rows.mapInArrow(tidy(_blocks), BLOCKS), "blocks")
    anchors = materialize(rows.where(F.col("vec_id") % ANCHOR_EVERY == 0).mapInArrow(tidy(_anchor_rows), ANCHORS), "anchors")
    n_rows = blocks.agg(F.sum("n")).first()[0] or 0
    down, across = max(1, math.ceil(anchors.count() / CELL_ANCHORS)), max(1, math.ceil(n_rows / CELL_ROWS))
    found = _grid(anchors, blocks, down, across, _positives, "uid long, score long, positive_id long")
    order = Window.partitionBy("uid").orderBy(F.desc("score"), F.asc_nulls_last("positive_id"))
    found = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= POSITIVES)
    windows = found.groupBy("uid").agg(F.collect_list(F.struct("place", "score", "positive_id")).alias("positives"))
    asked = anchors.join(windows.withColumnRenamed("uid", "uid_of"), F.col("uid") == F.col("uid_of")).drop("uid_of")
    out = _grid(asked, blocks, down, across, _negatives,
                "uid long, anchor_id long, place int, positive_id long, positive_score long, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("uid", "place").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id")))
    return out.withColumn("rank", rank).where(F.col("rank") <= NEGATIVES).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE_SQL = """
    WITH v AS MATERIALIZED (
      SELECT row_number() OVER () AS uid, vec_id,
             CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(CAST(256 AS DOUBLE) * CAST(x AS DOUBLE))) AS vec
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS MATERIALIZED (
      SELECT a.uid, a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same,
             CAST(list_inner_product(a.vec, r.vec) AS BIGINT) AS score
      FROM v a JOIN v r ON a.vec_id % 100 = 0 AND len(a.vec) = len(r.vec)
       AND (r.label <> a.label OR r.vec_id IS DISTINCT FROM a.vec_id)),
    positives AS (
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id NULLS LAST) AS place FROM scored WHERE same)
      WHERE place <= 5),
    negatives AS (
      SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
             row_number() OVER (PARTITION BY p.uid, p.place ORDER BY n.score DESC, n.vec_id NULLS LAST) AS rank
      FROM positives p JOIN scored n ON n.uid = p.uid AND NOT n.same
       AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
    FROM negatives WHERE rank <= 10
"""
