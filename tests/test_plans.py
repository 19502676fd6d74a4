"""Plan shape: the scale properties the design relies on."""

import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

import __spark_entry__ as entry
from chanloom.operators import classify as C
from chanloom.operators import parse as P
from chanloom.sources import fixtures as FX

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_dedupe_limits_before_exchange(spark):
    plan = _plan(entry.queries()["dedupe_url"](spark, SF))
    tree = plan.split("\n\n\n")[0]
    # a partial WindowGroupLimit sits below the exchange of the url window
    assert tree.count("WindowGroupLimit") >= 2
    assert tree.index("Exchange") < tree.rindex("WindowGroupLimit")


def test_classification_is_a_projection(spark):
    e = spark.createDataFrame([("s", 1, "AzTV", "http://a/1", "", {}, 50, ["az"])],
                              "source_name string, entry_id long, name string, url string, group_title string, "
                              "attrs map<string,string>, source_weight int, source_tags array<string>")
    plan = _plan(C.classify(e, FX.FIXTURE_PROFILE))
    assert "Join" not in plan and "Exchange" not in plan
    # all UDF calls run in Arrow stages
    assert "BatchEvalPython" not in plan


def test_parse_splits_by_chunk(spark):
    lines = spark.createDataFrame([("s", 0, "#EXTINF:-1,A"), ("s", 1, "http://a")],
                                  "source_name string, line_no long, line string")
    plan = _plan(P.m3u_parse(lines, 1000))
    assert "hashpartitioning(source_name" in plan and "chunk" in plan


def test_scans_are_pruned(spark):
    plan = _plan(entry.queries()["classify_country"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int>" in plan


def test_attempts_are_limited_before_the_exchange(spark):
    plan = _plan(entry.queries()["best_attempt"](spark, SF)).split("\n\n\n")[0]
    assert plan.count("WindowGroupLimit") >= 2
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_attempt_numbers_are_filtered_below_the_join(spark):
    attempts = FX.url_attempts(spark, SF)
    tree = attempts.where("attempt <= 2")._jdf.queryExecution().optimizedPlan().toString()
    join = tree.index("Join Inner")
    assert "attempt" in tree[join:] and "<= 2" in tree[join:] and "<= 2" not in tree[:join]
