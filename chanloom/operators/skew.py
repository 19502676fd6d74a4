"""A left join that holds when a few keys have a large share of all rows.

Keys with more than ``task_rows`` rows on the left are found by one
aggregate (combined on the map side).  Their left rows are dealt over as many
salts as needed, and the one right row of such a key is replicated once a
salt; all other rows join as usual.  The hot keys are broadcast: there are
at most (rows of the left) / ``task_rows`` of them.  Nothing depends on the
byte thresholds of the adaptive planner.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key that a task may get.
TASK_ROWS = 1_000_000
#: Salts of rows with a null key, which match nothing.
NULL_SALTS = 4096


def hot_keys(rows: DataFrame, keys: list[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """(keys, _salts): keys with more than ``task_rows`` rows."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > task_rows)
    return counts.select(*keys, salts(F.col("_n"), task_rows).alias("_salts"))


def salts(n: Column, task_rows: int = TASK_ROWS) -> Column:
    """Parts that a key with ``n`` rows is dealt to."""
    return F.ceil(n / task_rows).cast("int")


def salted_left_join(left: DataFrame, right: DataFrame, keys: list[str], spread: list[Column], task_rows: int = TASK_ROWS,
                     hot: DataFrame | None = None) -> DataFrame:
    """``left.join(right, keys, "left")``.  ``spread`` is what tells rows of
    one key apart (deterministic, so that a task can run again).  ``hot``:
    the result of ``hot_keys`` where it is known; otherwise ``left`` is
    computed once more to count its keys."""
    hot = F.broadcast(hot_keys(left, keys, task_rows) if hot is None else hot)
    absent = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    dealt = F.xxhash64(*spread)
    salt = F.when(absent, F.pmod(dealt, F.lit(NULL_SALTS))).when(F.col("_salts").isNotNull(), F.pmod(dealt, F.col("_salts"))).otherwise(0)
    rows = left.join(hot, keys, "left").withColumn("_salt", salt.cast("int")).drop("_salts")
    last = F.coalesce("_salts", F.lit(1)) - 1
    copies = right.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), last))).drop("_salts")
    return rows.join(copies, [*keys, "_salt"], "left").drop("_salt")
