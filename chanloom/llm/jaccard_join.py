"""N-gram Jaccard self-join with Bayesian candidate pruning.

Two documents are linked when the sets of their five-word shingles (lower
case, white space as separator; a text of one to four words has one shingle)
have a Jaccard similarity of at least 0.8.

1. Equal word sequences collapse to one representative first, so a group of
   copies costs one row whatever its size.
2. MinHash bands propose candidates (30 bands of 5 values: a pair at exactly
   0.8 is missed with probability 7e-6, at 0.9 with 2e-12).
3. Inside a bucket, signatures are compared 25 values at a time; a pair goes
   when the posterior probability that its similarity reaches the threshold
   falls below ``TOLERANCE``.  Survivors only join families (a forest of
   edges a bucket, never all pairs).
4. Inside a family every surviving pair is verified on the whole shingle
   sets; links are counted, and verified links alone make the classes.

Large buckets and families are cut into blocks; every pair of blocks is a
task of its own, so no task holds more than two blocks and no pair is lost.

Defined cases: null and empty texts are copies of each other and link to
nothing else; repeated rows are copies; a class's id is its least doc_id
(null if it has none).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanloom.llm.common import WS, groups_of, materialize, offsets, text_batches, text_of, tidy
from chanloom.llm.components import components
from chanloom.llm.cuckoo import keep_one
from chanloom.llm.strings import codepoints, is_ws, mix, piece_hashes, word_spans

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 30, 5
HASHES = BANDS * ROWS
STEP = 25
TOLERANCE = 1e-6
BATCH_CHARS = 1_000_000
#: Members of a block: a task holds two at most.
BLOCK = 256
#: Characters of a family's block: long documents make smaller blocks.
BLOCK_CHARS = 4_000_000


def content_key(text: Column) -> Column:
    """16 bytes that equal word sequences share."""
    return F.unhex(F.md5(F.trim(F.lower(F.regexp_replace(text, WS, " ")))))


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts (with repeats), and the texts' offsets."""
    codes, docs = codepoints([t.lower() for t in texts])
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    starts, ends, doc = word_spans(is_ws(codes), docs)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    words = piece_hashes(codes, starts, ends)
    count = np.bincount(doc, minlength=len(texts))
    padded = np.concatenate([words, np.zeros(SHINGLE - 1, np.uint64)])
    ends_of = offsets(count)[1:][doc]
    place = np.arange(len(words))
    h = np.zeros(len(words), np.uint64)
    for k in range(SHINGLE):  # words after the document's end count as none
        inside = place + k < ends_of
        h = mix(h ^ np.where(inside, padded[k: k + len(words)], np.uint64(0)))
    number = np.where(count >= SHINGLE, count - SHINGLE + 1, np.minimum(count, 1))
    keep = place - offsets(count)[:-1][doc] < number[doc]
    return h[keep], offsets(number)


def _multipliers() -> np.ndarray:
    return mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)


def signatures(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """MinHash values (documents x HASHES, uint32); documents without
    shingles have none and must be left out by the caller."""
    full = np.diff(at) > 0
    out = np.zeros((len(at) - 1, HASHES), np.uint32)
    if full.any():
        heads = at[:-1][full]
        for k, a in enumerate(_multipliers()):
            out[full, k] = np.minimum.reduceat((hashes * a) >> np.uint64(32), heads).astype(np.uint32)
    return out


def _signed(batches):
    for batch in batches:
        for a, b, part in text_batches(batch, "text", BATCH_CHARS):
            hashes, at = shingles(part)
            values = signatures(hashes, at)
            bands = np.zeros((len(part), BANDS), np.uint64)
            for r in range(ROWS):
                bands = mix(bands ^ values[:, r::ROWS][:, :BANDS].astype(np.uint64))
            bands = mix(bands + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
            marks = (values & np.uint32(255)).astype(np.uint8)
            rows = batch.slice(a, b - a)
            full = np.diff(at) > 0
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * BANDS, pa.int32()), pa.array(bands.ravel()))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("key"), pa.array(full), pa.array([m.tobytes() for m in marks], pa.binary()), lists, pa.array([len(t) for t in part], pa.int64())],
                ["doc_id", "key", "full", "marks", "bands", "chars"])


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For n = STEP, 2 STEP, ... compared one-byte values: the fewest matches
    with which P(similarity >= threshold | matches) is not below tolerance
    (uniform prior; bytes of different values match once in 256)."""
    s = (np.arange(20_000) + 0.5) / 20_000
    p = s + (1 - s) / 256
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            like = m * np.log(p) + (n - m) * np.log1p(-p)
            like = np.exp(like - like.max())
            if like[s >= threshold].sum() >= tolerance * like.sum():
                out.append(m)
                break
    return out


def surviving(left: np.ndarray, right: np.ndarray, least: list[int], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (i of left, j of right) of the pairs that the incremental
    comparison keeps; with ``same`` only i < j."""
    found_i, found_j = [], []
    for i in range(len(left)):
        j = np.arange(i + 1 if same else 0, len(right))
        matches = np.zeros(len(j), np.int32)
        for step, need in enumerate(least):
            if not len(j):
                break
            cut = slice(step * STEP, (step + 1) * STEP)
            matches = matches + (right[j, cut] == left[i, cut]).sum(1)
            ok = matches >= need
            j, matches = j[ok], matches[ok]
        if len(j):
            found_i.append(np.full(len(j), i))
            found_j.append(j)
    if not found_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least member of each row's component among n rows."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            break
    return root


def in_blocks(rows: DataFrame, group: str, member: str, blocks: Column) -> DataFrame:
    """Deal the members of every group to pairs of blocks.  Adds task (one
    per pair of blocks), side (-1: the block with itself, 0 or 1: the lower
    or higher of two); each pair of members meets in exactly one task."""
    rows = rows.withColumn("nb__", blocks.cast("int")).withColumn("own__", F.pmod(F.xxhash64(member), F.col("nb__")).cast("int"))
    rows = rows.withColumn("other__", F.explode(F.sequence(F.lit(0), F.col("nb__") - 1)))
    low, high = F.least("own__", "other__"), F.greatest("own__", "other__")
    side = F.when(F.col("own__") == F.col("other__"), -1).when(F.col("own__") < F.col("other__"), 0).otherwise(1)
    return rows.withColumn("task", F.xxhash64(group, low, high)).withColumn("side", side.cast("int")).drop("nb__", "own__", "other__")


def _sides(group: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    side = group.column("side").to_numpy()
    if (side == -1).any():
        rows = np.flatnonzero(side == -1)
        return rows, rows, True
    return np.flatnonzero(side == 0), np.flatnonzero(side == 1), False


def _marks(group: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(group.column("marks").to_pylist()), np.uint8).reshape(group.num_rows, HASHES)


def candidate_edges(reps: DataFrame) -> DataFrame:
    """(a, b): forests over the pairs of representatives that share a bucket
    and survive the comparison of their signatures."""
    least = least_matches()

    def pairs(batches):
        for group in groups_of(batches, "task"):
            rows, cols, same = _sides(group)
            if not len(rows) or not len(cols):
                continue
            marks = _marks(group)
            i, j = surviving(marks[rows], marks[cols], least, same)
            if not len(i):
                continue
            root = _roots(group.num_rows, rows[i], cols[j])
            keys = group.column("key").to_pylist()
            at = np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays([pa.array([keys[x] for x in at], pa.binary()), pa.array([keys[x] for x in root[at]], pa.binary())], ["a", "b"])

    posted = reps.where("full").select("key", F.explode("bands").alias("band"))
    sizes = posted.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = in_blocks(posted.join(sizes, "band"), "band", "key", F.ceil(F.col("n") / BLOCK)).select("key", "task", "side")
    dealt = dealt.join(reps.select("key", "marks"), "key")
    tasks = dealt.repartition("task").sortWithinPartitions("task")
    return tasks.select("task", "side", "key", "marks").mapInArrow(tidy(pairs), "a binary, b binary")


def verified(families: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Exact check inside families.  In: family, key, copies, marks, text,
    chars, members, total_chars.  Out: (a, b, links): partial link counts of
    a key (b null), and forest edges of verified pairs (links 0)."""
    least = least_matches(threshold)

    def check(batches):
        for group in groups_of(batches, "task"):
            keys = group.column("key").to_pylist()
            if len(set(keys)) < len(keys):  # rows that repeat text and doc_id
                group = group.take(sorted({k: x for x, k in reversed(list(enumerate(keys)))}.values()))
            rows, cols, same = _sides(group)
            if not len(rows) or not len(cols):
                continue
            marks = _marks(group)
            i, j = surviving(marks[rows], marks[cols], least, same)
            if not len(i):
                continue
            i, j = rows[i], cols[j]
            hashes, at = shingles(group.column("text").to_pylist())
            sets = [np.unique(hashes[at[x]: at[x + 1]]) for x in range(group.num_rows)]
            universe, ids = np.unique(np.concatenate(sets), return_inverse=True)
            at = offsets([len(x) for x in sets])
            size = np.diff(at)
            flags = np.zeros(len(universe), bool)
            linked = np.zeros(len(i), bool)
            edges = np.flatnonzero(np.diff(i, prepend=-1))
            for a, b in zip(edges, [*edges[1:], len(i)]):
                x = i[a]
                mine = ids[at[x]: at[x + 1]]
                flags[mine] = True
                for c in range(a, b):
                    y = j[c]
                    shared = np.count_nonzero(flags[ids[at[y]: at[y + 1]]])
                    linked[c] = shared >= threshold * (size[x] + size[y] - shared)
                flags[mine] = False
            i, j = i[linked], j[linked]
            if not len(i):
                continue
            copies = group.column("copies").to_numpy()
            links = np.zeros(group.num_rows, np.int64)
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            root = _roots(group.num_rows, i, j)
            keys = group.column("key").to_pylist()
            counted, joined = np.flatnonzero(links), np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[x] for x in counted] + [keys[x] for x in joined], pa.binary()),
                 pa.array([None] * len(counted) + [keys[x] for x in root[joined]], pa.binary()),
                 pa.array(np.concatenate([links[counted], np.zeros(len(joined), np.int64)]))], ["a", "b", "links"])

    blocks = F.greatest(F.ceil(F.col("members") / BLOCK), F.least(F.ceil(F.col("total_chars") / BLOCK_CHARS), F.col("members")))
    dealt = in_blocks(families, "family", "key", blocks)
    tasks = dealt.repartition("task").sortWithinPartitions("task")
    return tasks.select("task", "side", "key", "copies", "marks", "text").mapInArrow(tidy(check), "a binary, b binary, links long")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(representatives: key, rep_id, copies, class_id, head (the key of the
    class's first document), links; members:
    doc_id, key), both written tables or built from them."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_of(docs, text).alias("text"))
    rows = rows.withColumn("key", content_key(F.col("text")))
    signed = materialize(rows.mapInArrow(tidy(_signed), "doc_id long, key binary, full boolean, marks binary, bands array<long>, chars long"), "signed")
    members = signed.select("doc_id", "key")
    # one scan of narrow rows finds each representative; its signature comes from its own row
    heads = signed.groupBy("key").agg(F.min("doc_id").alias("rep_id"), F.count(F.lit(1)).alias("copies"),
                                      F.any_value("full").alias("full"), F.any_value("chars").alias("chars"),
                                      F.any_value("marks").alias("marks"), F.any_value("bands").alias("bands"))
    reps = materialize(heads, "reps")
    family = components(candidate_edges(reps))
    sized = family.join(reps.select(F.col("key").alias("node"), "rep_id", "copies", "marks", "chars"), "node")
    sized = materialize(sized, "families")
    totals = sized.groupBy("root").agg(F.count(F.lit(1)).alias("members"), F.sum("chars").alias("total_chars"))
    wanted = sized.join(totals, "root").select(F.col("root").alias("family"), F.col("node").alias("key"), "rep_id", "copies", "marks", "chars", "members", "total_chars")
    texts = rows.select(F.col("key").alias("k__"), "text", F.col("doc_id").alias("d__"))
    whole = wanted.join(texts, (F.col("key") == F.col("k__")) & F.col("rep_id").eqNullSafe(F.col("d__"))).drop("k__", "d__")
    checked = materialize(verified(whole), "verified")
    links = checked.where("b is null").groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    same = components(checked.where("b is not null").select("a", "b"))
    named = same.join(reps.select(F.col("key").alias("node"), "rep_id"), "node")
    first = F.min(F.struct(F.col("rep_id").isNull().alias("none"), "rep_id", "node"))
    least = named.groupBy("root").agg(first.alias("first")).select("root", F.col("first.rep_id").alias("class_id"), F.col("first.node").alias("head"))
    named = named.join(least, "root").select(F.col("node").alias("key"), "class_id", "head")
    out = reps.select("key", "rep_id", "copies").join(named, "key", "left").join(links, "key", "left")
    found = out.select("key", "rep_id", "copies", F.coalesce("class_id", "rep_id").alias("class_id"), F.coalesce("head", "key").alias("head"),
                       F.coalesce("links", F.lit(0)).cast("long").alias("links"))
    return materialize(found, "classes"), members


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id (least doc_id of its class),
    rep_id (least doc_id of its copies), n_copies, n_links (documents linked
    to it, its copies included)."""
    reps, members = classes(docs, key, text)
    return members.join(reps, "key").select("doc_id", "class_id", "rep_id", F.col("copies").alias("n_copies"), (F.col("links") + F.col("copies") - 1).alias("n_links"))


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each class: its least doc_id."""
    reps, members = classes(docs, key, text)
    heads = reps.where("head = key").select(F.col("key").alias("mark__"), F.col("rep_id").alias("keep__"))
    times = members.groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("times__"))
    keepers = heads.join(times, (F.col("mark__") == F.col("key")) & F.col("keep__").eqNullSafe(F.col("doc_id"))).select("mark__", "keep__", "times__")
    return keep_one(docs, content_key(text_of(docs, text)), keepers, key)
