"""Document fingerprints by consistent weighted sampling (native).

A text is the multiset of its white-space separated words.  For sample k and
a word with count S, hashes of (word, k) give r, c ~ Gamma(2, 1) and
b ~ Uniform(0, 1); then

    t = floor(ln S / r + b),  ln a = ln c - r (t - b) - r,

and the sample is the (word, t) of least a.  Two texts draw the same sample
with probability sum min(S, T) / sum max(S, T), their generalised Jaccard
similarity.  Since a is a function of (word, t, k), the least a itself stands
for the sample.

Everything is DataFrame code.  Distinct texts are shuffled once, by document,
into parts of about ``PART_CHARS`` code points; words, their counts and the
samples are made behind that shuffle, without another one.  The next document
is found on ids alone (a range sort of narrow rows), and only the first
quarter of its text goes to the document before it.  A likeness of ``SAMPLES``
samples has a standard error of 0.09 at 0.5 and of 0.07 at 0.8.

Defined cases: null is the empty text, whose samples are all 0 (two empty
texts are alike, an empty and another one are not); rows that repeat doc_id
and text are one document in the order and get the same results (they are
compared once); documents with one doc_id and different texts follow by the
text's hash; a null doc_id comes after all others; whole texts are sampled,
however long; an empty table gives no rows; other columns of the input play
no part, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanloom.llm.common import WS, materialize, text_of

SAMPLES = 32
#: Samples of one group: the words' rows repeat once per group, and a group's
#: expressions stay small enough to be compiled.
GROUP = 8
KEY = ["k_none", "k_id", "k_text"]
#: Code points of documents that a task gets.
PART_CHARS = 8_000_000


def _uniform(bits: Column, shift: int, width: int) -> Column:
    part = F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << width) - 1))
    return (part + 0.5) / F.lit(float(1 << width))


def _sample(word: Column, group: Column, j: int) -> tuple[Column, Column, Column]:
    """(r, b, ln c) of sample GROUP * group + j for a word's hash."""
    one = F.xxhash64(word, group * GROUP + j)
    two = F.xxhash64(word, group * GROUP + j, F.lit(1))
    r = -F.log(_uniform(one, 0, 21) * _uniform(one, 21, 21))
    b = _uniform(one, 42, 21)
    c = -F.log(_uniform(two, 0, 32) * _uniform(two, 32, 32))
    return r, b, F.log(c)


def fingerprints(words: DataFrame, keys: list[str], weights: list[str], samples: int = SAMPLES) -> DataFrame:
    """Signatures of weighted term sets.

    ``words`` has one row per key and distinct term: ``keys``, ``word`` (its
    hash), and one weight column per variant (null or not positive: the term
    is absent).  Out: keys and, per variant, an array of ``samples`` 32-bit
    numbers.  Partitioning by the keys is kept: no shuffle is added."""
    groups = F.array(*[F.lit(g) for g in range(samples // GROUP)])
    rows = words.select(*keys, "word", *[F.log(F.when(F.col(w) > 0, F.col(w))).alias(w) for w in weights]).withColumn("g__", F.explode(groups))
    mins = []
    for j in range(GROUP):
        r, b, log_c = _sample(F.col("word"), F.col("g__"), j)
        for w in weights:
            t = F.floor(F.col(w) / r + b)
            mins.append(F.min(log_c - r * (t - b) - r).alias(f"{w}_{j}"))
    least = rows.groupBy(*keys, "g__").agg(*mins)
    code = lambda w, j: F.when(F.col(f"{w}_{j}").isNull(), F.lit(0)).otherwise(F.xxhash64(F.col(f"{w}_{j}")).bitwiseAND(F.lit(0xFFFFFFFF))).cast("long")
    parts = least.select(*keys, "g__", *[F.array(*[code(w, j) for j in range(GROUP)]).alias(w) for w in weights])
    every = parts.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("g__", *weights))).alias("p__"))
    return every.select(*keys, *[F.flatten(F.col(f"p__.{w}")).alias(w) for w in weights])


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples of two signatures."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return same / F.size(a).cast("double")


def as_string(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def _key(key: Column, text: Column) -> list[Column]:
    return [key.isNull().alias("k_none"), F.coalesce(key.cast("long"), F.lit(0).cast("long")).alias("k_id"), F.xxhash64(text).alias("k_text")]


def next_documents(ids: DataFrame) -> DataFrame:
    """``ids`` (KEY columns, distinct, times and others) with n_ columns: the
    KEY and times of the next key in ascending order, the first one's after
    the last."""
    order = [F.col(k) for k in KEY]
    sorted_ids = ids.repartitionByRange(*order).withColumn("part__", F.spark_partition_id())
    sorted_ids = materialize(sorted_ids, "ids")
    own = F.struct(*KEY, "times")
    within = Window.partitionBy("part__").orderBy(*order)
    heads = sorted_ids.groupBy("part__").agg(F.min(own).alias("head__"))
    # one row per range partition
    line = Window.orderBy("part__")
    every = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = heads.select(F.col("part__").alias("p__"), F.coalesce(F.lead("head__").over(line), F.first("head__").over(every)).alias("after__"))
    rows = sorted_ids.withColumn("next__", F.lead(own).over(within)).join(after, F.col("part__") == F.col("p__"))
    following = F.coalesce("next__", "after__")
    return rows.select(*ids.columns, *[following[k].alias(f"n_{k}") for k in [*KEY, "times"]])


def _words(text: Column) -> Column:
    return F.split(text, WS)


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.  The edited text replaces the
    last quarter of the code points by as many first ones of the next
    document (or all it has)."""
    whole = text_of(docs, text)
    rows = docs.select(*_key(F.col(key), whole), whole.alias("text"))
    ids = rows.select(*KEY, F.length("text").alias("n_chars")).groupBy(*KEY).agg(F.max("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("times"))
    pairs = materialize(next_documents(ids), "pairs")
    chars = pairs.agg(F.sum("n_chars")).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(chars / PART_CHARS))
    # one row of each key; the joins below keep this partitioning and order
    place = F.count(F.lit(1)).over(Window.partitionBy(*KEY).orderBy(*KEY).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    texts = rows.repartition(parts, *KEY).withColumn("place__", place).where("place__ = 1").drop("place__")
    on_next = [pairs[f"n_{k}"] == F.col(f"d.{k}") for k in KEY]
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    tails = pairs.repartition(parts, *[f"n_{k}" for k in KEY]).join(texts.alias("d"), on_next)
    tails = tails.select(*[pairs[k] for k in KEY], "n_chars", F.left(F.col("d.text"), quarter).alias("tail")).repartition(parts, *KEY)
    edited = F.concat(F.left("text", (F.col("n_chars") - quarter).cast("int")), F.col("tail"))
    both = texts.join(tails, KEY).select(*KEY, "n_chars", "text", edited.alias("edited"))
    split = both.select(*KEY, _words(F.col("text")).alias("a"), _words(F.col("edited")).alias("b"))
    split = split.select(*KEY, F.size("a").alias("n"), F.posexplode(F.concat("a", "b")).alias("pos", "w"))
    words = split.where("w != ''").groupBy(*KEY, F.xxhash64("w").alias("word")).agg(
        F.sum((F.col("pos") < F.col("n")).cast("long")).alias("own"), F.sum((F.col("pos") >= F.col("n")).cast("long")).alias("changed"))
    signatures = fingerprints(words, KEY, ["own", "changed"], samples)
    info = both.select(*KEY, "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    none = F.array_repeat(F.lit(0).cast("long"), samples)
    found = info.join(signatures, KEY, "left").select(*KEY, "n_chars", "edited_sha256", F.coalesce("own", none).alias("own"), F.coalesce("changed", none).alias("changed"))
    found = materialize(found, "fingerprints")
    nexts = found.select(*[F.col(k).alias(f"n_{k}") for k in KEY], F.col("own").alias("next_own"))
    out = found.join(pairs.select(*KEY, "times", *[f"n_{k}" for k in KEY]), KEY).join(nexts, [f"n_{k}" for k in KEY])
    out = out.withColumn("copy__", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return out.select(F.when(~F.col("k_none"), F.col("k_id")).alias("doc_id"), F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
                      as_string(F.col("own")).alias("fingerprint"), as_string(F.col("changed")).alias("edited_fingerprint"),
                      likeness(F.col("own"), F.col("changed")).alias("near_edited"), likeness(F.col("own"), F.col("next_own")).alias("near_next"))
