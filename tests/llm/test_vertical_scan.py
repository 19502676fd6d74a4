"""op13: the vertical scan against all inner products, and against its SQL."""

import collections
import math

import duckdb
import numpy as np
import pytest

from chanloom.llm import queries, vertical_scan

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
SCHEMA = "vec_id long, embedding array<float>, label int, uid long, score int, place string, block int"


def brute_force(rows):
    """All (vec_id, vector, label) against all, in Python integers."""
    held = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        held.append((i, [max(-(1 << 23), min(1 << 23, math.floor(256 * float(np.float32(x))))) for x in v], label))
    out = []
    for i, v, label in held:
        if i is None or i % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j is None, j, other) for j, w, other in held if len(w) == len(v)]
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        for s, _, j, _ in [s for s in scored if s[3] == label and s[2] != i][:5]:
            fit = [n for n in scored if n[3] != label and 30 * -s <= 100 * -n[0] <= 90 * -s][:10]
            out += [(i, j, k + 1, n[2], -s, -n[0]) for k, n in enumerate(fit)]
    return collections.Counter(out)


def mined(df):
    return collections.Counter(tuple(r[c] for c in COLUMNS) for r in vertical_scan.hard_negatives(df).collect())


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, 2, "p", 3) for i, v, label in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/{sf}/embeddings.parquet'")
    want = collections.Counter(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({vertical_scan.ORACLE_SQL})").fetchall())
    got = collections.Counter(tuple(r[c] for c in COLUMNS) for r in queries.QUERIES["op13_hard_negatives"](spark, f"/root/testdata/{sf}").collect())
    assert got == want and got


def test_ties_repeats_and_odd_rows(spark, monkeypatch):
    # small blocks and cells: bounds carry over, every cell of the grid has work
    for name, value in (("BLOCK_ROWS", 16), ("CELL_ROWS", 64), ("CELL_ANCHORS", 3), ("STEP", 2)):
        monkeypatch.setattr(vertical_scan, name, value)
    rng = np.random.default_rng(13)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, 9)], int(rng.integers(0, 4))) for i in range(0, 900, 3)]
    same = [0.25] * 9
    rows += [(1000 + i, same, i % 3) for i in range(60)]  # one vector, many labels
    rows += [(100, same, 2), (100, same, 2), (100, rows[1][1], 1)]  # a repeated anchor
    rows += [(None, same, 1), (None, same, 1), (5, None, 1), (10, same, None), (200, [None] * 9, 1), (300, [math.nan] + same[1:], 1), (400, [math.inf] + same[1:], 2)]
    rows += [(500, same[:4], 1), (501, same[:4], 1), (502, same[:4], 2), (600, [], 1), (601, [], 1), (602, [], 3)]
    rows += [(700 + 100 * i, [-x for x in same], 1) for i in range(2)]
    assert mined(frame(spark, rows)) == brute_force(rows)


def test_very_large_components(spark):
    rng = np.random.default_rng(14)
    rows = [(i * 50, [float(x) for x in rng.choice([1e30, -1e30, 3e4, 1.0, -2e4, 0.5], 70)], int(i % 3)) for i in range(40)]
    got = mined(frame(spark, rows))
    assert got == brute_force(rows) and got


def test_empty_tables(spark):
    assert mined(frame(spark, [])) == collections.Counter()
    assert mined(frame(spark, [(1, [0.5], 1)])) == collections.Counter()
    assert mined(frame(spark, [(100, [0.5], 1)])) == collections.Counter()
