"""End-to-end build from a landing directory, JSON configuration and samples."""

import glob
import json
import os
import tempfile

from chanloom.operators import search as SR
from chanloom.operators import search_index as SI
from chanloom.plans import job as J
from chanloom.plans import publish as PB
from chanloom.sources import published as PS

PL = "application/vnd.apple.mpegurl"

PLAYLISTS = {
    "alpha": "#EXTM3U\n#EXTINF:-1 tvg-id=\"AzTV.az\" tvg-logo=\"l\",AzTV\nhttp://a.example.az/1.m3u8\n"
             "#EXTGRP:Sport\n#EXTINF:-1,Eurosport HD\nhttps://b.example.com/2.m3u8\n"
             "#EXTINF:-1,XXX Hot\nhttp://c.example.com/3\n",
    "beta": "#EXTM3U\r\n#EXTINF:-1 group-title=\"News\",AzTV\r\nhttps://d.example.org/4.m3u8\r\n"
            "#EXTINF:-1,Dead One\r\nhttp://e.example.com/5.m3u8\r\n",
    "gamma": "#EXTINF:-1,Disabled\nhttp://f/6\n",
}


def _samples(spark, path):
    rows = [
        ("http://a.example.az/1.m3u8", 1, 200, PL, b"#EXTM3U\nseg1.ts", "", 10),
        ("http://a.example.az/seg1.ts", 1, 200, "video/mp2t", b"x", "", 5),
        ("https://b.example.com/2.m3u8", 1, 200, "video/mp2t", b"x", "", 30),
        ("https://d.example.org/4.m3u8", 1, 500, "", b"", "", 3),
        ("http://e.example.com/5.m3u8", 1, 404, "", b"", "", 3),
    ]
    spark.createDataFrame(rows, "url string, attempt int, status int, content_type string, body binary, "
                                "error string, elapsed_ms int").write.mode("overwrite").parquet(path)


def _joined(out, name):
    """The text of an ordered output: its parts in name order."""
    parts = sorted(glob.glob(os.path.join(out, name, "part-*")))
    return "".join(open(p, encoding="utf-8").read() for p in parts)


def _folders(out, name):
    return sorted(os.path.basename(d) for d in glob.glob(os.path.join(out, name, "*=*")))


def test_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="chanloom-e2e-", dir="/tmp")
    land = os.path.join(root, "landing")
    os.makedirs(land)
    for name, text in PLAYLISTS.items():
        with open(os.path.join(land, f"{name}.m3u"), "w", encoding="utf-8") as f:
            f.write(text)
    sources = {"sources": [
        {"name": "alpha", "url": "https://x/alpha.m3u", "weight": 90, "tags": ["az"]},
        {"name": "beta", "url": "https://x/beta.m3u"},
        {"name": "gamma", "url": "https://x/gamma.m3u", "enabled": False},
        {"name": "", "url": "https://x/none.m3u"},
    ]}
    sp = os.path.join(root, "sources.json")
    with open(sp, "w") as f:
        json.dump(sources, f)
    op = os.path.join(root, "overrides.json")
    with open(op, "w") as f:
        json.dump({"by_name": {"Eurosport HD": {"categories": ["sport", "cinema"]}}, "by_url": {}}, f)
    samples = os.path.join(root, "samples")
    _samples(spark, samples)
    out = os.path.join(root, "out")
    res = J.run_build(spark, land, sp, None, op, samples, out, manifest_dir=os.path.join(root, "manifest"))
    out = PB.current(spark, out)

    stats = {r.stat: r.value for r in res.stats.collect()}
    assert stats["sources_total"] == 3 and stats["sources_ok"] == 2
    assert stats["entries_fetched_raw"] == 4          # XXX Hot filtered; gamma disabled
    assert stats["entries_after_dedupe"] == 3         # two AzTV copies share a channel
    assert stats["entries_relaxed"] == 2 and stats["entries_dead"] == 1

    text = _joined(out, "all.m3u.parts")
    lines = text.splitlines()
    assert lines[0] == '#EXTM3U x-tvg-url="" x-playlist-name="Custom Auto IPTV"'
    # AzTV: level 3, https fallback not needed; Eurosport level 1
    assert lines[1] == ('#EXTINF:-1 group-title="Azerbaijan | General" tvg-id="AzTV.az" tvg-logo="l" '
                        'tvg-name="AzTV",AzTV')
    assert lines[2] == "http://a.example.az/1.m3u8"
    assert lines[3].startswith('#EXTINF:-1 group-title="Azerbaijan | Sport"') and lines[3].endswith(",Eurosport HD")
    assert len(lines) == 5 and text.endswith("\n")

    assert _joined(out, "by-category-all.m3u.parts") == text
    az = ('#EXTM3U x-tvg-url="" x-playlist-name="Custom Auto IPTV - Azerbaijan"',
          '#EXTINF:-1 group-title="Azerbaijan" tvg-id="AzTV.az" tvg-logo="l" tvg-name="AzTV",AzTV', "http://a.example.az/1.m3u8",
          '#EXTINF:-1 group-title="Azerbaijan" tvg-name="Eurosport HD",Eurosport HD', "https://b.example.com/2.m3u8")
    assert tuple(_joined(out, "by-country/country=az").splitlines()) == az
    assert _folders(out, "by-country") == ["country=az"]
    # one entry per category: Eurosport HD was overridden to two
    assert _folders(out, "by-category") == ["category=cinema", "category=general", "category=sport"]
    for category, title in (("cinema", "Cinema"), ("sport", "Sport")):
        got = _joined(out, f"by-category/category={category}").splitlines()
        assert got[0] == f'#EXTM3U x-tvg-url="" x-playlist-name="Custom Auto IPTV - {title}"'
        assert got[1].startswith(f'#EXTINF:-1 group-title="{title}"') and got[2:] == ["https://b.example.com/2.m3u8"]
    strict = _joined(out, "strict/all.m3u.parts").splitlines()
    assert strict[0] == '#EXTM3U x-tvg-url="" x-playlist-name="Custom Auto IPTV (Strict)"'
    assert strict[2:] == ["http://a.example.az/1.m3u8"]
    report = spark.read.json(os.path.join(out, "reports", "audit-totals")).first()
    assert (report.relaxed_total, report.strict_total, report.az_channels_total, report.other_country_total) == (2, 1, 2, 0)
    assert report.generated_at_utc.endswith("+00:00")

    chans = spark.read.parquet(os.path.join(out, "channels.parquet"))
    assert chans.count() == 2
    assert {r.country for r in chans.collect()} == {"az"}
    # the version read back: every playlist in order, and the index beside the channels
    lists = {}
    for r in sorted(PS.read_playlists(spark, out).collect(), key=lambda r: (r.playlist, r.line_no)):
        lists.setdefault(r.playlist, []).append((r.line_no, r.line))
    assert [line for _, line in lists["all"]] == lines and lists["by-category-all"] == lists["all"]
    assert [n for n, _ in lists["all"]] == [1, 2, 3, 4, 5]
    assert tuple(line for _, line in lists["by-country/az"]) == az
    assert set(lists) == {"all", "by-category-all", "by-country-all", "by-country/az", "by-category/cinema", "by-category/general", "by-category/sport"}
    for text in ("euro", "EUROSPORT h", "az", "zz top", "", "alpha"):
        for tier in (None, "strict"):
            scan = SR.catalogue_search(PS.read_channels(spark, out), text, tier=tier).select("name").collect()
            assert sorted(SI.catalogue_search(spark, out, text, tier=tier).select("name").collect()) == sorted(scan)

    src = {r["source"]: (r["ok"], r["count"]) for r in spark.read.json(os.path.join(out, "reports", "source-report")).collect()}
    assert src == {"alpha": (True, 3), "beta": (True, 2)}


def test_cli_parses_arguments():
    import pytest

    from chanloom.__main__ import main
    with pytest.raises(SystemExit):
        main(["build", "--landing", "x"])  # missing required arguments
