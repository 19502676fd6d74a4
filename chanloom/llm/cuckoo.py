"""Exact deduplication through sharded cuckoo-filter indexes.

A shard holds a bounded range of digests: a cuckoo filter (16-bit
fingerprints, four slots a bucket) in front of a bucketed store of the full
digests and content lengths.  A filter miss inserts without looking; a hit is
verified against the store's bucket, so the result is exact; when an insert
finds no free slot the filter doubles and is refilled from the stored keys.
Digests can be deleted while the index lives.

Equal texts: identical after each run of white space (space, U+0009 to
U+000D) becomes one space.  Null counts as the empty text.  The smallest
doc_id of a group stays (null after all numbers); of rows that repeat both
text and doc_id one stays.  Empty tables give empty results.
"""

from __future__ import annotations

from array import array

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanloom.llm.common import WS, groups_of, materialize, text_of, tidy

SLOTS = 4
MAX_KICKS = 200
#: Rows that one shard may receive on average.
ROWS_PER_SHARD = 50_000
#: Digests that a map task combines before it sends them on.
COMBINE = 100_000


class CuckooFilter:
    """Partial-key cuckoo hashing over 64-bit keys."""

    def __init__(self, capacity: int):
        buckets = 2
        while buckets * SLOTS * 0.9 < capacity:
            buckets *= 2
        self.mask = buckets - 1
        self.slots = array("H", bytes(2 * buckets * SLOTS))
        self.spare = None

    def _place(self, key: int) -> tuple[int, int]:
        return (key >> 48) or 1, key & self.mask

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 & self.mask)

    def _find(self, key: int) -> int:
        mark, bucket = self._place(key)
        for b in (bucket, self._other(bucket, mark)):
            for s in range(b * SLOTS, b * SLOTS + SLOTS):
                if self.slots[s] == mark:
                    return s
        return -1

    def __contains__(self, key: int) -> bool:
        return self._find(key) >= 0

    def add(self, key: int) -> bool:
        """False when no slot was found; the filter must then be rebuilt."""
        mark, bucket = self._place(key)
        other = self._other(bucket, mark)
        for b in (bucket, other):
            for s in range(b * SLOTS, b * SLOTS + SLOTS):
                if not self.slots[s]:
                    self.slots[s] = mark
                    return True
        b = other
        for kick in range(MAX_KICKS):
            s = b * SLOTS + (mark + kick) % SLOTS
            mark, self.slots[s] = self.slots[s], mark
            b = self._other(b, mark)
            for s in range(b * SLOTS, b * SLOTS + SLOTS):
                if not self.slots[s]:
                    self.slots[s] = mark
                    return True
        return False

    def remove(self, key: int) -> None:
        s = self._find(key)
        if s >= 0:
            self.slots[s] = 0


class CuckooIndex:
    """Filter and bucketed store of one shard: digest -> [first id, copies]."""

    def __init__(self, capacity: int = 64):
        self.capacity = max(capacity, SLOTS)
        self.filter = CuckooFilter(self.capacity)
        self.store: dict[int, list] = {}
        self.live = 0
        self.resizes = 0

    @staticmethod
    def key(digest: str) -> int:
        # the digits after those that choose the shard
        return int(digest[16:32], 16)

    def _entry(self, digest: str):
        key = self.key(digest)
        if key not in self.filter:
            return None
        for entry in self.store.get(key, ()):  # verify the hit
            if entry[0] == digest:
                return entry
        return None

    def _resize(self) -> None:
        self.capacity *= 2
        self.resizes += 1
        self.filter = CuckooFilter(self.capacity)
        if not all(self.filter.add(key) for key, held in self.store.items() for _ in held):
            self._resize()

    def insert(self, digest: str, doc_id, copies: int = 1) -> bool:
        """True for a new digest; else its entry gains the copies."""
        entry = self._entry(digest)
        if entry is not None:
            if entry[1] is None or (doc_id is not None and doc_id < entry[1]):
                entry[1] = doc_id
            entry[2] += copies
            return False
        key = self.key(digest)
        self.store.setdefault(key, []).append([digest, doc_id, copies])
        self.live += 1
        if not self.filter.add(key):
            self._resize()
        return True

    def delete(self, digest: str) -> bool:
        entry = self._entry(digest)
        if entry is None:
            return False
        key = self.key(digest)
        held = self.store[key]
        held.remove(entry)
        if not held:
            del self.store[key]
        self.filter.remove(key)
        self.live -= 1
        return True

    def entries(self):
        return (entry for held in self.store.values() for entry in held)


def digest_of(text: Column) -> Column:
    """Lowercase hex SHA-256 of the normalised text."""
    return F.sha2(F.regexp_replace(text, WS, " "), 256)


def _combined(batches):
    """One row per digest and task (or per COMBINE digests): a group of
    copies sends a few rows, whatever its size."""
    held: dict[str, list] = {}

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array([v[0] for v in held.values()], pa.int64()), pa.array([v[1] for v in held.values()], pa.int64())],
            ["digest", "doc_id", "copies"])

    for batch in batches:
        for digest, doc in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            have = held.get(digest)
            if have is None:
                held[digest] = [doc, 1]
                continue
            have[1] += 1
            if have[0] is None or (doc is not None and doc < have[0]):
                have[0] = doc
        if len(held) > COMBINE:
            yield out()
            held = {}
    if held:
        yield out()


def _table(index: CuckooIndex, shard: int) -> pa.RecordBatch:
    rows = list(index.entries())
    return pa.RecordBatch.from_arrays(
        [pa.array([shard] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())],
        ["shard", "digest", "keep_id", "group_size"])


def _changed(batches):
    for group in groups_of(batches, "shard"):
        index = CuckooIndex()
        for digest, doc, copies, drop in zip(*(group.column(c).to_pylist() for c in ("digest", "doc_id", "copies", "gone"))):
            if drop:
                index.delete(digest)
            else:
                index.insert(digest, doc, copies)
        yield _table(index, group.column("shard")[0].as_py())


def _shard(shards: int) -> Column:
    return F.pmod(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"), F.lit(shards)).cast("int")


def _run(changes: DataFrame, shards: int) -> DataFrame:
    rows = changes.withColumn("shard", _shard(shards)).repartition("shard").sortWithinPartitions("shard", "step", "gone", "digest", "doc_id")
    return rows.mapInArrow(tidy(_changed), "shard int, digest string, keep_id long, group_size long")


def shard_count(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_SHARD))


def build_index(digests: DataFrame, shards: int) -> DataFrame:
    """Index of a (digest, doc_id) table: shard, digest, keep_id, group_size."""
    rows = digests.select("digest", F.col("doc_id").cast("long")).mapInArrow(tidy(_combined), "digest string, doc_id long, copies long")
    return _run(rows.withColumn("gone", F.lit(False)).withColumn("step", F.lit(0)), shards)


def update_index(index: DataFrame, inserts: DataFrame | None, deletes: DataFrame | None, shards: int) -> DataFrame:
    """A new index: ``deletes`` (digest) leave the live ones first, then
    ``inserts`` (digest, doc_id) come in.  ``shards`` as in ``build_index``."""
    cols = ("digest", "doc_id", "copies", "gone", "step")
    rows = index.select("digest", F.col("keep_id").alias("doc_id"), F.col("group_size").alias("copies"), F.lit(False).alias("gone"), F.lit(0).alias("step"))
    if deletes is not None:
        rows = rows.unionByName(deletes.select("digest", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("copies"), F.lit(True).alias("gone"), F.lit(1).alias("step")))
    if inserts is not None:
        fresh = inserts.select("digest", F.col("doc_id").cast("long")).mapInArrow(tidy(_combined), "digest string, doc_id long, copies long")
        rows = rows.unionByName(fresh.select(*cols[:3], F.lit(False).alias("gone"), F.lit(2).alias("step")))
    return _run(rows.select(*cols), shards)


def duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    narrow = materialize(docs.select(F.col(key).cast("long").alias("doc_id"), digest_of(text_of(docs, text)).alias("digest")), "digests")
    index = build_index(narrow, shard_count(narrow.count())).select("digest", "keep_id", "group_size")
    rows = narrow.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("times")).join(index, "digest")
    rows = rows.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return rows.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("digest").alias("text_sha256"))


def keep_one(docs: DataFrame, mark: Column, keepers: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose (``mark``, key) is in ``keepers`` (columns
    mark__, keep__, and times__: how many rows of ``docs`` carry both), one
    row for each of them."""
    rows = docs.select(F.struct("*").alias("row__"), mark.alias("mark__"), F.col(key).cast("long").alias("key__"))
    joined = rows.join(keepers, "mark__").where(F.col("key__").eqNullSafe(F.col("keep__")))
    once = joined.where("times__ = 1")
    again = joined.where("times__ > 1").dropDuplicates(["mark__"])
    return once.unionByName(again).select("row__.*")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that repeat another row's text."""
    narrow = materialize(docs.select(F.col(key).cast("long").alias("doc_id"), digest_of(text_of(docs, text)).alias("digest")), "digests")
    index = build_index(narrow, shard_count(narrow.count()))
    times = narrow.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("times__"))
    keepers = index.join(times, (index["digest"] == times["digest"]) & F.col("keep_id").eqNullSafe(F.col("doc_id")))
    keepers = materialize(keepers.select(index["digest"].alias("mark__"), F.col("keep_id").alias("keep__"), "times__"), "keepers")
    return keep_one(docs, digest_of(text_of(docs, text)), keepers, key)
