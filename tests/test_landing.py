"""Landing directory: blocks, same names, versions, emptied playlists."""

import os
import tempfile
import time

import pytest

from chanloom.operators import parse as P
from chanloom.operators import reports as RP
from chanloom.sources import manifest as M
from chanloom.sources import readers as R
from chanloom.streaming import landing as L


def _write(path, text, mtime=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    if mtime:
        os.utime(path, (mtime, mtime))


def _entry(name, url):
    return f"#EXTINF:-1,{name}\n{url}\n"


def _sources(spark, *names):
    return spark.createDataFrame([(n, f"http://{n}", True) for n in names], "name string, url string, enabled boolean")


def _parsed(spark, root, *names):
    """The entries, by a whole listing and by a manifest."""
    sources = _sources(spark, *names)
    got = P.m3u_parse(R.playlist_lines(spark, str(root), sources)).collect()
    files = M.refresh(spark, tempfile.mkdtemp(prefix="manifest-", dir="/tmp"), str(root))
    logged = P.m3u_parse(R.playlist_lines(spark, str(root), sources, files=files)).collect()
    key = lambda rows: sorted((r.source_name, r.name, r.url) for r in rows)
    assert key(got) == key(logged)
    return sorted((r.source_name, r.entry_id, r.name, r.url) for r in got)


def test_files_of_one_name_are_not_mixed(spark, tmp_path):
    now = time.time()
    _write(tmp_path / "a/x.m3u", _entry("A0", "http://a/0") + _entry("A1", "http://a/1"), now - 100)
    _write(tmp_path / "b/x.m3u", "#EXTM3U\n" + _entry("B0", "http://b/0"), now)
    _write(tmp_path / "y z+1.m3u", _entry("Y", "http://y"))
    got = _parsed(spark, tmp_path, "x", "y z+1")
    assert [(s, n, u) for s, _, n, u in got] == [("x", "B0", "http://b/0"), ("y z+1", "Y", "http://y")]


def test_newest_version_counts_even_when_empty(spark, tmp_path):
    now = time.time()
    _write(tmp_path / "x~1.m3u", _entry("Old", "http://old"), now - 50)
    _write(tmp_path / "x~2.m3u", _entry("New", "http://new"), now - 40)
    _write(tmp_path / "e~1.m3u", _entry("Gone", "http://gone"), now - 50)
    _write(tmp_path / "e~2.m3u", "", now - 40)
    assert [g[2] for g in _parsed(spark, tmp_path, "x", "e")] == ["New"]
    src = _sources(spark, "x", "e", "absent")
    parsed = P.m3u_parse(R.playlist_lines(spark, str(tmp_path), src))
    report = {r.source: (r.ok, r["count"], r.error) for r in RP.source_report(src, parsed, R.fetch_results(spark, str(tmp_path))).collect()}
    assert report == {"x": (True, 1, ""), "e": (True, 0, ""), "absent": (False, 0, "not_fetched")}


def test_fetch_log(spark, tmp_path):
    _write(tmp_path / "land/x.m3u", _entry("X", "http://x"))
    _write(tmp_path / "log/1.json", '{"source": "x", "elapsed_ms": 12}\n{"source": "f", "error": "HTTP Error 404", "elapsed_ms": 7}\n')
    got = {r.source_name: (r.error, r.elapsed_ms) for r in R.fetch_results(spark, str(tmp_path / "land"), str(tmp_path / "log")).collect()}
    assert got == {"x": ("", 12), "f": ("HTTP Error 404", 7)}


@pytest.mark.parametrize("block", ["64", "1000", "1m"])
def test_blocks_of_a_file_do_not_matter(spark, tmp_path, block):
    text = "#EXTM3U\r\n" + "".join(f"#EXTGRP:G{i}\r\n" * (i % 3 == 0) + _entry(f"n{i}é\u2028#c", f"http://u/{i}") for i in range(60))
    _write(tmp_path / "x.m3u", text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        got = _parsed(spark, tmp_path, "x")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [g[3] for g in got] == [f"http://u/{i}" for i in range(60)]
    assert [g[2] for g in got] == [f"n{i}é" for i in range(60)]


def test_large_playlist_is_whole(spark, tmp_path):
    n = 220_000
    _write(tmp_path / "big.m3u", "".join(_entry(f"channel number {i}", f"http://example.org/{i}") for i in range(n)))
    assert os.path.getsize(tmp_path / "big.m3u") > 12_000_000
    parsed = P.m3u_parse(R.playlist_lines(spark, str(tmp_path), _sources(spark, "big")))
    assert parsed.count() == n
    assert parsed.where(f"url = 'http://example.org/{n - 1}'").first().name == f"channel number {n - 1}"


def test_stream_follows_the_newest_version(spark, tmp_path):
    land, entries, ckpt = (str(tmp_path / d) for d in ("land", "entries", "ckpt"))
    now = time.time()
    _write(f"{land}/a/x~1.m3u", _entry("Old", "http://old"), now - 50)
    _write(f"{land}/b/x~2.m3u", _entry("New", "http://new"), now - 40)
    _write(f"{land}/e~1.m3u", _entry("E", "http://e"), now - 50)
    L.ingest_playlists(spark, land, entries, ckpt).awaitTermination()
    assert sorted(r.name for r in L.latest_entries(spark, entries).collect()) == ["E", "New"]
    _write(f"{land}/e~2.m3u", "", now - 30)
    L.ingest_playlists(spark, land, entries, ckpt).awaitTermination()
    assert sorted(r.name for r in L.latest_entries(spark, entries).collect()) == ["New"]


def test_lines_are_scanned_once(spark, tmp_path):
    _write(tmp_path / "x.m3u", _entry("A", "http://a"))
    parsed = P.m3u_parse(R.playlist_lines(spark, str(tmp_path), _sources(spark, "x")))
    parsed.collect()
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert final.count("FileScan text") == 1 and "ReusedExchange" in final


def _state(df):
    return {r.source_name: (os.path.basename(r.file), r.length == 0, r.batch_id) for r in df.collect()}


def test_manifest_follows_what_lands(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "EPOCH", 2)
    root, land, now = str(tmp_path / "log"), tmp_path / "land", time.time() - 10_000
    _write(land / "x~1.m3u", _entry("Old", "http://old"), now)
    _write(land / "e~1.m3u", _entry("E", "http://e"), now)
    assert _state(M.refresh(spark, root, str(land))) == {"x": ("x~1.m3u", False, 0), "e": ("e~1.m3u", False, 0)}
    assert _state(M.refresh(spark, root, str(land)))["x"][2] == 0  # nothing new, no batch
    for i in range(2, 8):  # over several epochs; one source is emptied and filled again
        _write(land / f"d{i}/x~{i}.m3u", _entry(f"v{i}", "http://x"), now + i)
        _write(land / f"d{i}/e~{i}.m3u", "" if i % 2 else _entry("E", "http://e"), now + i)
        got = _state(M.refresh(spark, root, str(land)))
        assert got == {"x": (f"x~{i}.m3u", False, i - 1), "e": (f"e~{i}.m3u", bool(i % 2), i - 1)}
    assert sorted(os.listdir(f"{root}/log")) == [f"epoch={k}" for k in range(4)] and len(os.listdir(f"{root}/snapshots")) == 3
    # an older version that lands late changes nothing
    _write(land / "late/x~0.m3u", _entry("late", "http://late"), now - 50)
    assert _state(M.refresh(spark, root, str(land)))["x"] == ("x~7.m3u", False, 6)


def test_only_new_files_are_looked_at(spark, tmp_path):
    root, land, now = str(tmp_path / "log"), tmp_path / "land", time.time()
    for i in range(20):
        _write(land / f"s{i}~1.m3u", "" if i % 2 else _entry("a", "http://a"), now - 30 * 86_400 - i)
    _write(land / "new~1.m3u", "", now)
    M.refresh(spark, root, str(land))
    _write(land / "new~2.m3u", "", now + 5)
    seen = []
    listing = R.playlist_files

    def watched(*args, **kwargs):
        seen.append(listing(*args, **kwargs))
        return seen[-1]

    M.playlist_files, before = watched, M.playlist_files
    try:
        assert [r.source_name for r in M.found_since(spark, root, str(land)).collect()] == ["new"]
    finally:
        M.playlist_files = before
    assert sorted(os.path.basename(r.file) for r in seen[0].collect()) == ["new~1.m3u", "new~2.m3u"]


def test_a_batch_that_runs_again(spark, tmp_path, monkeypatch):
    """The log of a failed batch is written again, with its empty files."""
    monkeypatch.setattr(M, "EPOCH", 1)
    root, land, now = str(tmp_path / "log"), tmp_path / "land", time.time() - 100
    rows = lambda before: R.newest_files(M.found_since(spark, root, str(land), before=before))
    _write(land / "x~1.m3u", _entry("A", "http://a"), now)
    M.append(rows(0), root, 0)
    _write(land / "x~2.m3u", "", now + 1)
    _write(land / "y~1.m3u", _entry("B", "http://b"), now + 1)
    for _ in range(2):
        M.append(rows(1), root, 1)
        assert _state(M.newest(spark, root)) == {"x": ("x~2.m3u", True, 1), "y": ("y~1.m3u", False, 1)}


def test_names_that_look_like_globs(spark, tmp_path):
    names = ["a[1]", "b{x,y}", "c d+e", "f*", "ü%20", "q?"]
    for n in names:
        _write(tmp_path / f"{n}.m3u", _entry(f"in {n}", "http://u"))
    assert [g[2] for g in _parsed(spark, tmp_path, *names)] == sorted(f"in {n}" for n in names)
