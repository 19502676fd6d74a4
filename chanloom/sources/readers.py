"""Native inputs: source registry, playlists, overrides, samples, fetch log.

* The source registry and overrides are JSON documents (configuration).
* Playlists are text files in a landing directory, named
  ``<source name>.m3u`` or ``<source name>~<version>.m3u``, in any folder.
  Files are read in blocks, so a large one is many tasks; lines keep their
  file and block.  Of several files of a source the newest counts, also when
  it is empty.
* Captured HTTP samples (the probe input) and the fetch log are tables.
"""

from __future__ import annotations

import json
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Profile, profile_of
from ..operators.classify import override_tables
from ..functions.text import py_strip, split_lines

SOURCES_SCHEMA = ("sources array<struct<name:string,url:string,enabled:string,weight:string,"
                  "tags:array<string>>>")


def document(spark: SparkSession, path: str) -> DataFrame:
    """A configuration document as one row ``value``, from any file system
    that Spark reads."""
    return spark.read.text(path, wholetext=True)


def registry_rows(documents: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Sources with a name and a URL of registry documents (JSON texts);
    defaults enabled=true, weight=50, tags=[]."""
    listed = F.from_json(value, SOURCES_SCHEMA, {"mode": "FAILFAST"})["sources"]
    s = documents.select(*keep, F.explode(F.coalesce(listed, F.array())).alias("s")).select(*keep, "s.*")
    return s.where((F.coalesce(F.col("name"), F.lit("")) != "") & (F.coalesce(F.col("url"), F.lit("")) != "")) \
        .select(*keep, "name", "url",
                (~F.coalesce(F.col("enabled"), F.lit("true")).isin("false", "0", "")).alias("enabled"),
                F.coalesce(F.col("weight").cast("double"), F.lit(50)).cast("int").alias("weight"),
                F.coalesce(F.col("tags"), F.array().cast("array<string>")).alias("tags"))


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a registry document."""
    return registry_rows(document(spark, path))


def read_profile(spark: SparkSession, path: str) -> Profile:
    """A profile document.  Its rules are compiled on the driver, so this one
    document comes there; rule tables of any size are DataFrames
    (``operators.rule_tables``)."""
    return profile_of(json.loads(document(spark, path).first()["value"]))


LINES_SCHEMA = "source_name string, chunk long, line_no long, line string"


def read_overrides(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(by_name, by_url) tables; a missing file gives empty tables."""
    try:
        found = document(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([("{}",)], "value string")
    return override_tables(found)


def source_of(path: Column) -> Column:
    """Source name of a playlist file: its name up to ``~`` or the last dot."""
    return F.regexp_extract(_decoded(path), r"([^/~]+)(?:~[^/]*)?\.[^./~]+$", 1)


def _decoded(path: Column) -> Column:
    """A file path without its URI escapes (``+`` stands for itself)."""
    return F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def playlist_files(spark: SparkSession, landing_dir: str, pattern: str = "*.m3u", modified_after: str | None = None) -> DataFrame:
    """(source_name, file, modified, length) of every playlist file, or of
    those modified after a time (session time zone); contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after)
    files = reader.load(landing_dir)
    listed = list_files(files)
    return listed.unionByName(_empty_files(files, listed))


def list_files(files: DataFrame) -> DataFrame:
    """The listing of a ``binaryFile`` frame, batch or stream."""
    path = F.col("_metadata.file_path")
    return files.select(source_of(path).alias("source_name"), path.alias("file"),
                        F.col("modificationTime").alias("modified"), "length")


def _empty_files(files: DataFrame, listed: DataFrame) -> DataFrame:
    """Files of no bytes: Spark lists them but its sources skip them, so only
    their names come from the driver's listing (``manifest`` keeps that to
    new files), and their times from the file system."""
    spark = files.sparkSession
    # written as in the metadata column: an empty authority is left out
    names = spark.createDataFrame([(re.sub("^file:/+", "file:/", p),) for p in files.inputFiles()], "file string")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def modified(name: str) -> int:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        return path.getFileSystem(conf).getFileStatus(path).getModificationTime()

    empty = [(r.file, modified(r.file)) for r in names.join(listed, "file", "left_anti").collect()]
    rows = spark.createDataFrame(empty, "file string, ms long")
    return rows.select(source_of(F.col("file")).alias("source_name"), "file", F.timestamp_millis("ms").alias("modified"), F.lit(0).cast("long").alias("length"))


def newest_files(files: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One file per source: the last modified, of equals the last by path."""
    columns = ("modified", "file", "length", *extra)
    newest = F.max(F.struct(*columns)).alias("f")
    return files.groupBy("source_name").agg(newest).select("source_name", *[f"f.{c}" for c in ("file", "modified", "length", *extra)])


def file_lines(raw: DataFrame, files: DataFrame) -> DataFrame:
    """Lines of the chosen ``files``: (source_name, chunk, line_no, line).

    ``raw`` has the text source's rows with ``file`` and ``block``.  Numbers
    grow in reading order inside a block (a block is read by one task)."""
    pieces = raw.select("file", "block", F.explode(split_lines(F.make_valid_utf8("value"))).alias("piece"))
    numbered = pieces.select("file", F.col("block").alias("chunk"), F.monotonically_increasing_id().alias("line_no"),
                             py_strip(F.col("piece")).alias("line"))
    chosen = files.select("source_name", "file")
    return numbered.where("line != ''").join(chosen, "file").select("source_name", "chunk", "line_no", "line")


def text_rows(spark: SparkSession, paths: str | list[str], pattern: str = "*.m3u") -> DataFrame:
    raw = (spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(paths))
    return raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def playlist_lines(spark: SparkSession, landing_dir: str, sources: DataFrame,
                   pattern: str = "*.m3u", files: DataFrame | None = None) -> DataFrame:
    """Lines of the newest playlist of every enabled source.  ``files``: the
    newest files where they are known (``manifest``); then only these are
    opened, at most one a source, and nothing is listed."""
    enabled = sources.where("enabled").select(F.col("name").alias("source_name"))
    if files is None:
        chosen = newest_files(playlist_files(spark, landing_dir, pattern)).join(enabled, "source_name", "left_semi")
        return file_lines(text_rows(spark, landing_dir, pattern), chosen)
    return chosen_lines(files.join(enabled, "source_name", "left_semi"), pattern)


def chosen_lines(files: DataFrame, pattern: str = "*.m3u") -> DataFrame:
    """Lines of exactly these files (one name a source comes to the driver,
    which plans the scan)."""
    found = files.where("length > 0").select(_decoded(F.col("file")).alias("path")).collect()
    if not found:
        return files.sparkSession.createDataFrame([], LINES_SCHEMA)
    paths = [re.sub(r"([\\*?\[\]{}])", r"\\\1", r.path) for r in found]  # no globs
    return file_lines(text_rows(files.sparkSession, paths, pattern), files)


def fetch_results(spark: SparkSession, landing_dir: str, log_path: str | None = None, pattern: str = "*.m3u",
                  files: DataFrame | None = None) -> DataFrame:
    """(source_name, error, elapsed_ms): a row per source that was fetched or
    tried.  Files that landed are fetched; the log (JSON lines ``source,
    error, elapsed_ms``), if there is one, adds times and failures."""
    listed = playlist_files(spark, landing_dir, pattern) if files is None else files
    landed = listed.select("source_name").distinct().withColumn("landed", F.lit(True))
    if log_path is None:
        return landed.select("source_name", F.lit("").alias("error"), F.lit(None).cast("int").alias("elapsed_ms"))
    log = spark.read.schema("source string, error string, elapsed_ms int").json(log_path)
    log = log.groupBy(F.col("source").alias("source_name")).agg(F.first("error").alias("e"), F.max("elapsed_ms").alias("elapsed_ms"))
    both = log.join(landed, "source_name", "full")
    missing = F.when(F.col("landed"), F.lit("")).otherwise(F.lit("not_fetched"))
    return both.select("source_name", F.coalesce(F.nullif("e", F.lit("")), missing).alias("error"), "elapsed_ms")


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """Captured HTTP responses (``url, attempt, status, content_type, body,
    error, elapsed_ms``)."""
    df = spark.read.parquet(path)
    if "attempt" not in df.columns:
        df = df.withColumn("attempt", F.lit(1))
    for c, t in (("error", "string"), ("elapsed_ms", "int"), ("content_type", "string")):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(t))
    return df.select("url", F.col("attempt").cast("int"), F.col("status").cast("int"), "content_type",
                     F.col("body").cast("binary"), "error", F.col("elapsed_ms").cast("int"))
