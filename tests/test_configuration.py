"""Configuration documents through Spark's readers, on any file system."""

import json

import pytest

from chanloom.operators import classify as C
from chanloom.sources import readers as R


@pytest.fixture
def remote(spark, tmp_path):
    """A path that only Spark's readers can open."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set(f"fs.viewfs.mounttable.{tmp_path.name}.link./in", f"file:{tmp_path}")
    return tmp_path, f"viewfs://{tmp_path.name}/in"


def python_overrides(document):
    """The rows of a document by plain dictionaries."""
    out = []
    for section in ("by_name", "by_url"):
        items = document.get(section) if isinstance(document, dict) else None
        for position, (key, meta) in enumerate((items if isinstance(items, dict) else {}).items()):
            own = meta if isinstance(meta, dict) else {}
            labels = own.get("categories")
            out.append((section, position, key, str(own.get("country") or ""), [str(c) for c in labels] if isinstance(labels, list) else [], str(own.get("name") or ""), isinstance(meta, dict)))
    return out


def rank(rows):
    """Positions as places in their section (a repeated key leaves a gap)."""
    out = []
    for section in ("by_name", "by_url"):
        own = sorted((r for r in rows if r[0] == section), key=lambda r: r[1])
        out += [(section, i, *r[2:]) for i, r in enumerate(own)]
    return out


def spark_overrides(tables):
    names, urls = tables
    rows = [("by_name", r.position, r.key, r.country, r.categories, r.name, r.is_object) for r in names.collect()]
    return rank(rows + [("by_url", r.position, r.url, r.country, r.categories, r.name, r.is_object) for r in urls.collect()])


DOCUMENTS = [
    '{"by_name": {"Z": {"country": "az"}, "A": {"name": "New \\"A\\""}, "M": "text", "N": null, "L": [1], "B": true}, "by_url": {"http://u/1": {"categories": ["x", 2]}}}',
    '{"by_name": {"K": {"country": "az"}, "J": {}, "K": {"name": "last"}}}',
    '{"by_url": {"ü 漢": {"name": 7, "country": "", "categories": null}}, "other": {"by_name": {"X": {}}}}',
    '{"by_name": [], "by_url": 5}', "{}", "[1, 2]", '"text"', "null", "  \n{\"by_name\": {\"x\": {}}}\n",
]


@pytest.mark.parametrize("text", DOCUMENTS)
def test_override_documents(spark, remote, text):
    folder, path = remote
    (folder / "o.json").write_text(text, encoding="utf-8")
    assert spark_overrides(R.read_overrides(spark, f"{path}/o.json")) == rank(python_overrides(json.loads(text)))


def test_missing_and_broken_overrides(spark, remote):
    folder, path = remote
    assert spark_overrides(R.read_overrides(spark, f"{path}/absent.json")) == []
    (folder / "broken.json").write_text('{"by_name": {"A": {}')
    with pytest.raises(Exception, match="MALFORMED"):
        spark_overrides(R.read_overrides(spark, f"{path}/broken.json"))


def test_many_overrides_keep_their_order(spark, remote):
    folder, path = remote
    document = {"by_name": {f"Channel {i * 7919 % 20011}": {"country": f"c{i}"} for i in range(20_000)}}
    (folder / "o.json").write_text(json.dumps(document))
    by_name, _ = R.read_overrides(spark, f"{path}/o.json")
    rows = sorted(by_name.collect(), key=lambda r: r.position)
    assert [(r.key, r.country) for r in rows] == [(k, v["country"]) for k, v in document["by_name"].items()]
    # the first of several keys that normalise to one name counts
    entries = spark.createDataFrame([("channel 5", "u", "other", ["general"])], "norm_name string, url string, country string, categories array<string>").withColumn("name", C.F.col("norm_name"))
    twice = spark.createDataFrame([('{"by_name": {"CHANNEL-5": {"country": "one"}, "Channel 5": {"country": "two"}}}',)], "value string")
    assert C.apply_overrides(entries, *C.override_tables(twice)).first().country == "one"


def test_profile_and_registry(spark, remote):
    folder, path = remote
    (folder / "p.json").write_text(json.dumps({"healthcheck": {"retries": 5}, "groups": {"countries": [{"id": "é", "title": "É"}]}}, ensure_ascii=False), encoding="utf-8")
    profile = R.read_profile(spark, f"{path}/p.json")
    assert profile.retries == 5 and profile.country_titles() == {"é": "É"} and profile.categories == []
    (folder / "s.json").write_text(json.dumps({"sources": [{"name": "a", "url": "u", "weight": "7", "enabled": False}, {"name": "b", "url": "v"}, {"url": "w"}, {"name": "c"}]}, indent=1))
    rows = sorted(map(tuple, R.read_sources(spark, f"{path}/s.json").collect()))
    assert rows == [("a", "u", False, 7, []), ("b", "v", True, 50, [])]
