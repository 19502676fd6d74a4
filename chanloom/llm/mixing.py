"""Mixing sources to target weights by pivotal dependent rounding.

Every source has a target in words; a document should be taken
target / source_size times, which is a whole number of copies and a fraction.
Fractions are rounded in pairs: mass (in words) moves from one document to
the other, with probabilities that keep each document's expected copies,
until one fraction is 0 or 1.  The words of a pair stay what they were, so a
source's taken words differ from its target by less than one document; one
last copy is exchanged to make up for that.

The pairs form a reduction tree: leaves of about ``LEAF`` documents of one
source leave one open fraction each, ``FAN`` of those meet in a node of the
next level, and so on.  A hot source has many leaves, never one task.  All
random numbers are hashes of (seed, document, level), so reruns agree.

Defined cases: a null text has size 0 and takes 0 words; null sources are one
source, the last; repeated rows are documents of their own; an empty table
gives an empty result; sources without words have target 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanloom.llm.common import groups_of, materialize, text_of, tidy
from chanloom.llm.strings import mix

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5, 2, 1)
CAP = 3.0
LEAF = 2_000
FAN = 64
SEED = 20_260


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Water filling in closed form: with sources by cap / weight, the first k
    are held at their cap for the k whose rest level stays below the next
    one's ratio.  The windows run over one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.count(F.lit(1)).alias("source_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    wheel = F.array(*[F.lit(float(w)) for w in weights])
    ranked = per.withColumn("w", F.element_at(wheel, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    ranked = ranked.withColumn("top", F.col("source_size") * F.lit(float(cap))).withColumn("ratio", F.col("top") / F.col("w"))
    line = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    rest = line.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("top").over(before), F.lit(0.0))) / F.sum("w").over(rest)
    held = F.col("level") > F.col("ratio")
    leveled = ranked.withColumn("level", level)
    final = F.min(F.when(~held, F.struct("ratio", "level"))).over(every)["level"]
    target = F.least(F.col("top"), F.coalesce(final, F.lit(float("inf"))) * F.col("w"))
    return leveled.withColumn("target", target).select("source", "source_size", "source_docs", "target")


def _uniform(ids: list, level: int, seed: int) -> np.ndarray:
    return (mix(mix(np.asarray(ids, dtype=np.int64).view(np.uint64)) ^ np.uint64(seed * 64 + level)) >> np.uint64(11)).astype(np.float64) / (1 << 53)


def pivot(fraction: np.ndarray, size: np.ndarray, random: np.ndarray) -> np.ndarray:
    """Round fractions pairwise, in order; at most one stays open.  For a and
    b with mass size * fraction, up to min(mass left in b, room in a) words
    can move to a, or the other way round; either is done with the
    probability that keeps both expectations."""
    p = fraction.copy()
    open_at = -1
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        if open_at < 0:
            open_at = i
            continue
        a, b = open_at, i
        to_a = min((1 - p[a]) * size[a], p[b] * size[b])
        to_b = min(p[a] * size[a], (1 - p[b]) * size[b])
        if random[i] * (to_a + to_b) < to_b:
            full, empty, moved = a, b, to_a
        else:
            full, empty, moved = b, a, to_b
        fills = (1 - p[full]) * size[full] <= p[empty] * size[empty]
        drains = p[empty] * size[empty] <= (1 - p[full]) * size[full]
        p[full] = 1.0 if fills else p[full] + moved / size[full]
        p[empty] = 0.0 if drains else p[empty] - moved / size[empty]
        open_at = next((x for x in (a, b) if 0.0 < p[x] < 1.0), -1)
    return p


def _rounded(level: int, seed: int):
    def run(batches):
        for group in groups_of(batches, "node"):
            p = pivot(group.column("fraction").to_numpy().copy(), group.column("size").to_numpy().astype(np.float64), _uniform(group.column("uid").to_pylist(), level, seed))
            at = group.schema.get_field_index("fraction")
            yield from group.set_column(at, "fraction", pa.array(p)).combine_chunks().to_batches()

    return run


def mix_sources(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS, cap: float = CAP, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target,
    copies, taken (copies * size)."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(source).alias("source"), word_count(text_of(docs, text)).alias("size"), F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("h"))
    rows = materialize(rows, "sizes")
    targets = materialize(source_targets(rows, weights, cap), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    dealt = rows.join(targets.withColumnRenamed("source", "s__"), F.col("source").eqNullSafe(F.col("s__"))).drop("s__")
    whole = F.floor(rate)
    dealt = dealt.select("doc_id", "source", "size", "source_size", "target", whole.cast("long").alias("base"),
                         F.when(F.col("size") > 0, rate - whole).otherwise(0.0).alias("fraction"),
                         F.xxhash64("doc_id", "h").alias("uid"), F.greatest(F.lit(1), F.ceil(F.col("source_docs") / LEAF)).cast("long").alias("leaves"))
    most = targets.agg(F.max("source_docs")).first()[0] or 0
    leaves, level = max(1, -(-most // LEAF)), 0
    leaf = F.pmod("uid", F.col("leaves"))
    now = dealt.withColumn("place", leaf)
    schema = "doc_id long, source string, size long, source_size long, target double, base long, fraction double, uid long, place long, node long"
    done = []
    while True:
        tasks = now.withColumn("node", F.xxhash64("source", "place")).repartition("node").sortWithinPartitions("node", "size", "uid", "doc_id")
        out = materialize(tasks.select("doc_id", "source", "size", "source_size", "target", "base", "fraction", "uid", "place", "node").mapInArrow(tidy(_rounded(level, seed)), schema), f"level{level}")
        is_open = (F.col("fraction") > 0) & (F.col("fraction") < 1)
        done.append(out.where(~is_open))
        if leaves == 1:
            last = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "uid"), 11) / F.lit(float(1 << 53))
            done.append(out.where(is_open).withColumn("fraction", F.when(last < F.col("fraction"), 1.0).otherwise(0.0)))
            break
        now = out.where(is_open).withColumn("place", F.floor(F.col("place") / FAN).cast("long"))
        leaves, level = -(-leaves // FAN), level + 1
    every = done[0]
    for part in done[1:]:
        every = every.unionByName(part)
    copies = (F.col("base") + F.col("fraction").cast("long")).alias("copies")
    every = materialize(every.select("doc_id", "uid", "size", "source", "source_size", "target", copies), "rounded")
    return _balanced(every, cap)


def _balanced(plan: DataFrame, cap: float) -> DataFrame:
    """The last open fraction of a source was rounded alone, which leaves up
    to one document's words too many or too few.  Per source, one copy of the
    document whose size is nearest to that difference is dropped or added."""
    diff = plan.groupBy("source").agg((F.sum(F.col("copies") * F.col("size")) - F.max("target")).alias("over"))
    diff = diff.withColumnRenamed("source", "s__")
    rows = plan.join(diff, F.col("source").eqNullSafe(F.col("s__")))
    gap = F.abs(F.abs("over") - F.col("size"))
    able = (F.col("size") > 0) & (gap < F.abs("over")) & F.when(F.col("over") > 0, F.col("copies") > 0).otherwise(F.col("copies") + 1 <= cap)
    best = rows.where(able).groupBy("source").agg(F.min(F.struct(gap.alias("gap"), "uid", "doc_id")).alias("b"), F.max("over").alias("over"))
    best = best.select(F.col("source").alias("s__"), F.col("b.uid").alias("u__"), F.col("b.doc_id").alias("d__"), F.when(F.col("over") > 0, -1).otherwise(1).cast("long").alias("change__"))
    # rows that repeat text and doc_id: only one of them changes
    hit = plan.join(best, F.col("source").eqNullSafe(F.col("s__")) & (F.col("uid") == F.col("u__")) & F.col("doc_id").eqNullSafe(F.col("d__")), "left")
    first = F.row_number().over(Window.partitionBy("s__", "u__", "d__").orderBy(F.when(F.col("change__") > 0, F.col("copies")).otherwise(-F.col("copies"))))
    one = hit.where("change__ is not null").withColumn("change__", F.when(first == 1, F.col("change__")).otherwise(F.lit(0)))
    out = hit.where("change__ is null").unionByName(one)
    copies = F.col("copies") + F.coalesce("change__", F.lit(0))
    return out.select("doc_id", "size", "source", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it (a document
    without words once).  Rows that agree in doc_id, source and size share
    the sum of their copies."""
    plan = mix_sources(docs, key, text, source).withColumn("copies", F.when(F.col("size") == 0, 1).otherwise(F.col("copies")))
    plan = plan.groupBy(F.col("doc_id").alias("d__"), F.col("source").alias("s__"), F.col("size").alias("z__")).agg(F.sum("copies").alias("copies__"), F.count(F.lit(1)).alias("rows__"))
    rows = docs.select(F.struct("*").alias("row__"), F.col(key).cast("long").alias("key__"), F.col(source).alias("source__"), word_count(text_of(docs, text)).alias("own__"))
    same = F.col("key__").eqNullSafe(F.col("d__")) & F.col("source__").eqNullSafe(F.col("s__")) & (F.col("own__") == F.col("z__"))
    rows = rows.join(plan, same)
    # rows that repeat share their copies evenly, the first ones take the rest
    nth = F.row_number().over(Window.partitionBy("d__", "s__", "z__").orderBy(F.lit(0))) - 1
    single = rows.where("rows__ = 1").withColumn("n__", F.col("copies__"))
    shared = rows.where("rows__ > 1").withColumn("nth__", nth)
    shared = shared.withColumn("n__", F.floor(F.col("copies__") / F.col("rows__")) + (F.col("nth__") < F.pmod("copies__", "rows__")).cast("long")).drop("nth__")
    times = single.unionByName(shared).where("n__ > 0")
    return times.withColumn("i__", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n__")))).select("row__.*")
