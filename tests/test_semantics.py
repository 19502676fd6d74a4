"""Edge semantics listed in SURVEY section 2.13."""

import json
import tempfile

from pyspark.sql import functions as F

from chanloom.config import Profile
from chanloom.operators import classify as C
from chanloom.operators import health as H
from chanloom.plans import build as B
from chanloom.sources.readers import read_profile

ENTRY = ("source_name string, entry_id long, name string, url string, group_title string, "
         "attrs map<string,string>, source_weight int, source_tags array<string>")


def _classify(spark, countries, rows):
    df = spark.createDataFrame(rows, ENTRY)
    return {r.entry_id: r.country for r in C.classify(df, Profile(countries=countries, categories=[])).collect()}


def test_repeated_suffix_later_country_wins(spark):
    countries = [{"id": "a", "tvg_id_suffixes": [".x", ".y"]}, {"id": "b", "tvg_id_suffixes": [".x"]}]
    rows = [("s", 1, "n", "http://h/1", "", {"tvg-id": "Foo.x"}, 50, []),
            ("s", 2, "n", "http://h/2", "", {"tvg-id": "Foo.y"}, 50, [])]
    assert _classify(spark, countries, rows) == {1: "b", 2: "a"}


def test_punctuation_suffix_matches_any_tvg_id(spark):
    countries = [{"id": "p", "tvg_id_suffixes": ["."]}, {"id": "q", "keywords": ["n"]}]
    rows = [("s", 1, "n", "http://h/1", "", {"tvg-id": "anything"}, 50, []),
            ("s", 2, "n", "http://h/2", "", {"tvg-id": ""}, 50, [])]
    assert _classify(spark, countries, rows) == {1: "p", 2: "q"}


def test_lock_does_not_select_its_country(spark):
    countries = [{"id": "a", "tvg_id_suffixes": [".az"], "keywords": ["news"]},
                 {"id": "b", "tlds": [".tr"]}]
    rows = [("s", 1, "News", "http://h.example.tr/", "", {"tvg-id": "X.az@SD"}, 50, [])]
    assert _classify(spark, countries, rows) == {1: "b"}


def test_keep_error_option(spark):
    rows = [("u", 1, 0, None, None, "entry:404"), ("u", 2, 0, None, None, "entry:500")]
    df = spark.createDataFrame(rows, "url string, attempt int, check_level int, status_code int, "
                                     "latency_ms int, error string")
    assert H.best_attempt(df, 2).first().error == "unknown"
    assert H.best_attempt(df, 2, keep_error=True).first().error == "entry:404"


def test_health_check_disabled(spark):
    sel = spark.createDataFrame([("p", "https://h/1", ["f"], 50, {})],
                                "primary_url string, url string, fallback_urls array<string>, "
                                "source_weight int, attrs map<string,string>")
    ck = B.health_stage(sel, None, Profile(healthcheck_enabled=False)).checked.first()
    assert ck.check_level == 1 and ck.alive is None
    # weight 50 + https 10 + latency bonus 0 (NULL counts as 20 s) + level 5
    assert float(ck.score_dec) == 65.0


def test_load_profile_document(spark):
    doc = {"healthcheck": {"retries": 3, "max_fallbacks": 2}, "tiers": {"strict_min_level": 3},
           "channel_selection": {"keep_per_channel": 2, "max_fallback_urls": 5, "prefer_https": False},
           "groups": {"countries": [{"id": "x", "title": "X"}], "categories": []}}
    with tempfile.NamedTemporaryFile("w", suffix=".json", delete=False, dir="/tmp") as f:
        json.dump(doc, f)
    p = read_profile(spark, f.name)
    assert (p.retries, p.max_fallbacks, p.strict_min_level, p.relaxed_min_level) == (3, 2, 3, 1)
    assert (p.keep, p.max_fallback_urls, p.prefer_https) == (2, 5, False)
    assert p.country_titles() == {"x": "X"}


def test_negative_limits_rejected():
    import pytest

    with pytest.raises(ValueError):
        Profile(max_fallback_urls=-1)
