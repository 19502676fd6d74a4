"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import atexit
import ctypes
import sys
import types
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chanloom.session import ensure_checkpoint_dir

#: White space of every operator here: space and U+0009 to U+000D.
WS = "[\\x20\\x09-\\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame, name: str = "text") -> Column:
    """The whole text of a row; null counts as the empty text."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


_WRITTEN: list[tuple[SparkSession, str]] = []


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a stage boundary as Parquet into the session's shared checkpoint
    folder and read it back.  The rows are computed once, lineage ends here,
    and a lost executor costs a re-read only.  ``release()`` or the end of
    the driver removes the files."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/chanloom-llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _WRITTEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def release() -> None:
    """Delete every table that ``materialize`` has written in this driver."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        try:
            jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
        except Exception:  # the session has already ended
            return


atexit.register(release)


def worker_cache() -> types.ModuleType:
    """A module object that outlives one task in a reused Python worker.
    (Functions pickled by value get new globals in every task.)"""
    return sys.modules.setdefault("_chanloom_llm_worker", types.ModuleType("_chanloom_llm_worker"))


def tidy(run):
    """A ``mapInArrow`` function that gives freed memory back to the system
    at the end of a task: Python workers are reused, and what one task's
    buffers leave behind would add up beside the executor's heap."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return wrapped


def text_batches(batch: pa.RecordBatch, column: str, max_chars: int) -> Iterator[tuple[int, int, list[str]]]:
    """Runs of rows of at most ``max_chars`` code points (one row at least):
    bounds numpy temporaries whatever the batch holds."""
    texts = batch.column(column).to_pylist()
    start = held = 0
    for i, t in enumerate(texts):
        if held and held + len(t) > max_chars:
            yield start, i, texts[start:i]
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts), texts[start:]


def groups_of(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Contiguous groups of a stream sorted by ``key``: one table per key.
    Memory is bounded by the largest group, which callers bound by salting."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        edges = [0, *cuts.tolist(), len(keys)]
        for a, b in zip(edges[:-1], edges[1:]):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)


def offsets(lengths) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``arange(s, s + n)`` for each start and length."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    out = np.ones(total, dtype=np.int64)
    keep = lengths > 0
    s, n = starts[keep], lengths[keep]
    heads = np.zeros(len(n), dtype=np.int64)
    np.cumsum(n[:-1], out=heads[1:])
    out[heads[0]] = s[0]
    out[heads[1:]] = s[1:] - (s[:-1] + n[:-1] - 1)
    return np.cumsum(out)
