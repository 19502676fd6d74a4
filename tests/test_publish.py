"""Versions of outputs: a build that dies leaves the one before; the search
index reads few postings."""

import os

import pytest

from chanloom.operators import search as SR
from chanloom.operators import search_index as SI
from chanloom.plans import publish as PB
from chanloom.plans import sinks as K
from chanloom.config import Profile
from chanloom.sources import published as PS

COLUMNS = ("rank long, name string, url string, source_name string, source_weight int, source_tags array<string>, group_title string, country string, categories array<string>, "
           "alive boolean, status_code int, latency_ms int, check_error string, check_level int, tier string, score double, score_dec decimal(12,2), primary_url string, attrs map<string,string>")


def ranked(spark, names):
    from decimal import Decimal

    rows = [(i + 1, n, f"http://u/{i}", f"source {i % 3}", 50, [], f"Group {i % 4}", ["01", "tr", "ö/%=é"][i % 3], [["a"], [], ["b", "a"]][i % 3], True, 200, 5, "", 1 + i % 2, ["relaxed", "strict"][i % 2],
             100.0 - i, Decimal(100 - i), f"http://u/{i}", {}) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, COLUMNS)


def build(spark, out, names):
    folder = PB.begin(spark, out)
    K.write_playlists(ranked(spark, names), folder, Profile(), "T")
    PB.commit(spark, folder)
    return folder


def names_of(spark, out):
    rows = PS.read_playlists(spark, PB.current(spark, out)).where("playlist = 'all' and line like '#EXTINF%'").orderBy("line_no").collect()
    return [r.line.rsplit(",", 1)[1] for r in rows]


def test_a_build_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        PB.current(spark, out)
    first = build(spark, out, ["one", "two"])
    assert names_of(spark, out) == ["one", "two"]
    write, done = K._write_ordered, []

    def dies(*args, **kwargs):
        if len(done) == 2:
            raise RuntimeError("executor and driver lost")
        done.append(write(*args, **kwargs))

    monkeypatch.setattr(K, "_write_ordered", dies)
    with pytest.raises(RuntimeError):
        build(spark, out, ["three"])
    monkeypatch.undo()
    assert PB.current(spark, out) == first and names_of(spark, out) == ["one", "two"]
    third = build(spark, out, ["four", "five", "six"])
    assert names_of(spark, out) == ["four", "five", "six"]
    build(spark, out, ["seven"])
    # the dead version and all complete ones but the last two go
    gone = PB.prune(spark, out, keep=2)
    left = sorted(os.listdir(f"{out}/versions"))
    assert os.path.basename(first) in gone and os.path.basename(third) in left and names_of(spark, out) == ["seven"] and len(left) == 2


def test_lines_of_many_parts(spark, tmp_path):
    names = [f"channel {i:03}" for i in range(97)]
    out = str(tmp_path / "out")
    folder = build(spark, out, names)
    assert names_of(spark, out) == names
    rows = PS.read_playlists(spark, folder).collect()
    by = {}
    for r in rows:
        by.setdefault(r.playlist, []).append(r.line_no)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in by.values())
    assert {"by-country/ö/%=é", "by-country/01", "by-category/general", "by-category/a", "by-country-all"} <= set(by)


def test_search_index_equals_scan(spark, tmp_path):
    names = [f"{a} {b} {i}" for i, (a, b) in enumerate((a, b) for a in ("Ring", "spring", "İstanbul", "STRAßE", "x", "", "rin ging") for b in ("HD", "kids", "é漢字", "a,b", "%"))]
    folder = str(tmp_path / "v")
    K.write_catalogue(ranked(spark, names), folder)
    table = PS.read_channels(spark, folder)
    for text in ("ring", "RING hd", "é漢", "漢字", "straße", "x", "", None, "  g 1  ", "group 2", "nothing at all", "source 1", "%", "ringing", "i̇st"):
        for where in ({}, {"country": "01"}, {"tier": "strict", "category": "a"}, {"country": "ö/%=é", "tier": "relaxed"}):
            want = sorted(r.rank for r in SR.catalogue_search(table, text, **where).collect())
            assert sorted(r.rank for r in SI.catalogue_search(spark, folder, text, **where).collect()) == want, (text, where)


def test_search_prunes_partitions(spark, tmp_path):
    folder = str(tmp_path / "v")
    K.write_catalogue(ranked(spark, [f"name {i}" for i in range(60)]), folder)
    found = SI.catalogue_search(spark, folder, "name 4", country="01", tier="strict")
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan parquet" in x]
    assert len(scans) == 2
    for scan in scans:
        assert "country" in scan[scan.index("PartitionFilters"):] and "tier" in scan[scan.index("PartitionFilters"):]
    postings = next(x for x in scans if "gram#" in x)
    assert "In(gram" in postings[postings.index("PushedFilters"):]
