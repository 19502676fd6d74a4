"""Every registered query against its SQL oracle (DuckDB) on sf0.001."""

import os
import re
import threading
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.oracle_check import TABLES, digest

SF = os.environ.get("CHANLOOM_TEST_SF", "/root/testdata/sf0.001")
# the training-data operators have tests of their own
OPTIONAL = re.compile(r"op\d+_.*|pipeline")
QUERIES = {k: f for k, f in entry.queries().items() if not OPTIONAL.fullmatch(k)}
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = Path(SF) / f"{t}.parquet"
        if p.exists():
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) & set(QUERIES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[key])
    sc, _, sh = digest(df.columns, rows)
    dc, _, dh = digest(rel.columns, rel.fetchall())
    assert sc == dc
    assert sh == dh


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_oracle_ends_under_a_limit(key):
    """A plan for one row must not lose the statement's join order."""
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('/root/testdata/sf0.01/{t}.parquet')")
    stop = threading.Timer(30, c.interrupt)
    stop.start()
    try:
        c.execute(f"select * from ({ORACLE[key]}) limit 1").fetchall()
    finally:
        stop.cancel()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 167
    assert "fallback_urls" in df.columns
