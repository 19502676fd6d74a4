"""Incremental landing-directory ingest with Trigger.AvailableNow."""

import os
import tempfile

from chanloom.streaming import landing as L


def test_available_now_ingest(spark):
    root = tempfile.mkdtemp(prefix="chanloom-stream-", dir="/tmp")
    land = os.path.join(root, "landing")
    os.makedirs(land)
    with open(os.path.join(land, "one.m3u"), "w") as f:
        f.write("#EXTM3U\n#EXTINF:-1,A\nhttp://a/1\n#EXTINF:-1,B\nhttp://a/2\n")
    entries = os.path.join(root, "entries")
    ckpt = os.path.join(root, "ckpt")
    L.ingest_playlists(spark, land, entries, ckpt).awaitTermination()
    assert sorted(r.name for r in L.latest_entries(spark, entries).collect()) == ["A", "B"]
    # a second run only picks up new files
    with open(os.path.join(land, "two.m3u"), "w") as f:
        f.write("#EXTINF:-1,C\nhttp://b/1\n")
    L.ingest_playlists(spark, land, entries, ckpt).awaitTermination()
    got = sorted((r.source_name, r.name) for r in L.latest_entries(spark, entries).collect())
    assert got == [("one", "A"), ("one", "B"), ("two", "C")]
