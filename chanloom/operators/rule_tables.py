"""Classification by rule tables of any size.

``classify`` compiles a few dozen rules into one expression.  Here rules are
DataFrames (``kind, position, value, rule_id``), so there may be millions:

* Substring and suffix rules: every pattern is keyed by the rarest of its
  q-grams (counted in the texts), texts are keyed by theirs, and an equi-join
  on the gram gives candidates, which are then verified.  Grams are as long
  as the pattern allows (``SIZES``), so that millions of numbered patterns do
  not meet under the few grams of four digits; they are joined as 64-bit
  hashes against the numbers of texts.  A gram that many texts hold is
  salted; its patterns are replicated once a salt.
* Tag rules: an equi-join.

Fields are normalised once per distinct combination of their raw values,
texts are matched once per distinct value, and results return to the entries
by a salted join, so a value that a third of all entries share is not one
task.  The text of a country's keywords has as many values as its fields have
combinations, so its fields are matched one by one and keywords that span them
by their pieces (``_Spans``).  Stage boundaries are written: the rules with their normalised texts,
the distinct inputs of the rules with their counts, the keyed patterns and
the matches of each kind.  So every plan stays small, however many kinds of
rules there are.  First-match priority is the least position; results equal those of
``classify``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations, count
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_array, normalize_text
from .classify import attr, with_normalized
from ..session import materialize
from .skew import TASK_ROWS, hot_keys, salted_left_join, salts

#: Lengths of grams; a pattern has grams of the longest one it reaches.
SIZES = (1, 2, 3, 4, 8, 16)
#: Rule kinds, and the field of a rule document that each comes from.
FIELDS = {"suffix": "tvg_id_suffixes", "keyword": "keywords", "tld": "tlds", "tag": "source_tags"}
#: The normalised column (``with_normalized``) of each raw field.
NORMAL = {"name": "norm_name", "group_title": "norm_group", "tvg-name": "norm_tvg_name", "tvg-id": "norm_tvg_id", "source_tags": "norm_tags"}
SCHEMA = "kind string, position long, value string, rule_id string"
#: The fields that a country's keywords are looked for in, in the order of the text; the host follows.
TEXT_FIELDS = ("name", "group_title", "tvg-name", "tvg-id")
#: Rows of a table that is sent to every task.
SMALL_ROWS = 50_000


def rule_table(spark: SparkSession, rules: Sequence[dict[str, Any]], default: str) -> DataFrame:
    """Rule documents as rows, in document order."""
    rows = [(kind, str(value), str(rule.get("id", default))) for kind, name in FIELDS.items() for rule in rules for value in rule.get(name) or []]
    return spark.createDataFrame([(kind, i, value, rule_id) for i, (kind, value, rule_id) in enumerate(rows)], SCHEMA)


def keyword_table(spark: SparkSession, keywords: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([("keyword", i, k, k) for i, k in enumerate(keywords)], SCHEMA)


def _grams(text: Column, n: Column) -> Column:
    """Hashes of the substrings of ``n`` characters (a shorter text has none)."""
    found = F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.xxhash64(F.substring(text, i, n)))
    return F.when(F.length(text) >= n, found).otherwise(F.array().cast("array<long>"))


def _size(text: Column) -> Column:
    """Length of the grams that key a pattern."""
    return reduce(lambda size, n: F.when(F.length(text) >= n, n).otherwise(size), SIZES[1:], F.lit(SIZES[0]))


def _no_ids() -> Column:
    return F.array().cast("array<string>")


def candidates(values: DataFrame, patterns: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """(value, text, rule): every value with every pattern whose rarest gram
    it holds.  ``values``: (value), distinct; ``patterns``: (text, rule),
    texts distinct and not empty."""
    text, value = F.col("text"), F.col("value")
    sizes = patterns.agg(F.collect_set(_size(text))).scalar()
    # numbered and written, so that grams carry a number instead of the text
    values = materialize(values.select("value", F.monotonically_increasing_id().alias("id")))
    by_size = [F.when(F.array_contains(sizes, F.lit(n)), _grams(value, F.lit(n))).otherwise(F.array().cast("array<long>")) for n in SIZES]
    held = values.select("id", F.explode(F.array_distinct(F.flatten(F.array(*by_size)))).alias("gram"))
    keys = patterns.select("text", "rule", F.explode(F.array_distinct(_grams(text, _size(text)))).alias("gram"))
    counts = held.join(keys.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))
    keyed = keys.join(counts, "gram", "left").groupBy("text").agg(rarest.alias("k"), F.first("rule").alias("rule")).where("k.n > 0")
    keyed = materialize(keyed.select("text", "rule", F.col("k.gram").alias("gram"), F.col("k.n").alias("n")))
    # at most (grams of all values) / task_rows rows
    hot = F.broadcast(keyed.where(F.col("n") > task_rows).select("gram", salts(F.col("n"), task_rows).alias("salts")).distinct())
    copies = keyed.select("text", "rule", "gram", F.explode(F.sequence(F.lit(0), salts(F.col("n"), task_rows) - 1)).alias("salt"))
    dealt = held.join(hot, "gram", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("id"), F.col("salts")), F.lit(0)).cast("int"))
    met = dealt.join(copies, ["gram", "salt"]).select("id", "text", "rule")
    return met.join(values, "id").select("value", "text", "rule")


def _edges(texts: DataFrame, size: Column, value: Column, at_end: bool) -> Column:
    """Hashes of the beginnings (or ends) of ``value`` that are as long as one
    of ``texts``, whose lengths are ``size``."""
    sizes = F.array(*[F.lit(r[0]) for r in texts.select(size).distinct().collect()]).cast("array<int>")
    fits = F.filter(sizes, lambda n: n <= F.length(value))
    return F.transform(fits, lambda n: F.xxhash64(F.substring(value, F.length(value) - n + 1 if at_end else F.lit(1), n)))


def matching(values: DataFrame, patterns: DataFrame, at_end: bool = False, task_rows: int = TASK_ROWS) -> DataFrame:
    """(value, text, rule): the value contains the text (or ends with it).  A
    text of the end is looked up whole, by its hash."""
    value, text = F.col("value"), F.col("text")
    if not at_end:
        return candidates(values, patterns, task_rows).where(value.contains(text))
    ends = values.select("value", F.explode(_edges(patterns, F.length(text), value, True)).alias("edge"))
    return salted_left_join(ends, patterns.withColumn("edge", F.xxhash64(text)), ["edge"], [value], task_rows).where(value.endswith(text)).select("value", "text", "rule")


def _first(pairs: DataFrame, name: str) -> DataFrame:
    return pairs.groupBy("value").agg(F.min("rule").alias(name))


def normalized_rules(rules: DataFrame) -> DataFrame:
    """The rules with their normalised texts, written."""
    return materialize(rules.select(*rules.columns, normalize_text(F.col("value")).alias("text")))


def _patterns(rules: DataFrame, kind: str) -> DataFrame:
    """(position, text, rule_id) of one kind of normalised rules."""
    return rules.where(F.col("kind") == kind).select("position", "text", "rule_id")


def _leading(patterns: DataFrame, owner: str = "first") -> DataFrame:
    """(text, rule): one rule per text, at its first position; it belongs to
    the first rule that has the text, or the last one."""
    owner_id = F.min_by("rule_id", "position") if owner == "first" else F.max_by("rule_id", "position")
    return patterns.groupBy("text").agg(F.min("position").alias("p"), owner_id.alias("r")).select("text", F.struct("p", "r").alias("rule"))


def _distinct(rows: DataFrame, column: Column) -> DataFrame:
    return rows.select(column.alias("value")).where(F.coalesce(F.col("value"), F.lit("")) != "").distinct()


def _with_raw(df: DataFrame, fields: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with the raw values of ``fields``, never null, and their names."""
    raw = {"name": F.coalesce("name", F.lit("")), "group_title": F.coalesce("group_title", F.lit("")), "tvg-name": attr("tvg-name"), "tvg-id": attr("tvg-id"),
           "host": F.coalesce("host", F.lit("")), "source_tags": F.transform(F.coalesce("source_tags", _no_ids()), lambda x: F.coalesce(x, F.lit("")))}
    keys = {f: f"_raw_{f.replace('-', '_')}" for f in fields}
    return df.withColumns({keys[f]: raw[f] for f in fields}), keys


def _inputs(df: DataFrame, fields: Sequence[str], inputs: dict[str, Column]) -> tuple[DataFrame, DataFrame, list[str]]:
    """``df`` with the raw values of ``fields``, their distinct combinations
    with counts (_n) and the ``inputs`` of the rules, written, and the names
    of the raw values.  ``inputs`` read the columns of ``with_normalized``,
    which are worked out from the raw values here, once per combination."""
    rows, keys = _with_raw(df, fields)
    each = rows.groupBy(*keys.values()).agg(F.count(F.lit(1)).alias("_n"))
    for f, normal in NORMAL.items():
        if f in keys:
            each = each.withColumn(normal, (normalize_array if f == "source_tags" else normalize_text)(F.col(keys[f])))
    return rows, materialize(each.withColumns(inputs).drop(*NORMAL.values())), list(keys.values())


def _attach(each: DataFrame, base: DataFrame, found: DataFrame, keys: list[str], task_rows: int) -> DataFrame:
    """``each`` with what was found for ``keys``; ``base`` has the same rows
    and is written, so keys are counted there."""
    return salted_left_join(each, found, keys, [F.xxhash64(*base.columns)], task_rows, hot_keys(base, keys, task_rows))


def _back(df: DataFrame, rows: DataFrame, each: DataFrame, base: DataFrame, keys: list[str], task_rows: int) -> DataFrame:
    """Every row with the result of its combination of inputs."""
    each = materialize(each)
    spread = [F.col(c) for c, kind in df.dtypes if not kind.startswith("map") and c not in NORMAL.values()]
    hot = base.where(F.col("_n") > task_rows).select(*keys, salts(F.col("_n"), task_rows).alias("_salts"))
    return salted_left_join(rows, each, keys, spread, task_rows, hot).drop(*keys)


def _tag_rules(rows: DataFrame, patterns: DataFrame, aggregate) -> DataFrame:
    """(_tags, found): rules whose text is one of the tags, per distinct list."""
    lists = rows.select("_tags").distinct()
    each = lists.select("_tags", F.explode(F.array_distinct("_tags")).alias("text"))
    return each.join(patterns, "text").groupBy("_tags").agg(aggregate.alias("found"))


def _numbered(each: DataFrame, keys: Sequence[str]) -> Column:
    """A number of ``keys`` that tells all rows of ``each`` apart."""
    for seed in count():
        number = F.xxhash64(F.lit(seed), *keys)
        if each.groupBy(number.alias("k")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            return number


def _looked_up(rows: DataFrame, found: DataFrame, keys: list[str], spread: list[Column], task_rows: int, hot: DataFrame | None = None) -> DataFrame:
    """``rows`` with what was found for ``keys``; ``found`` is written, and
    sent to every task where it is small, so that no row moves."""
    if found.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS:
        return rows.join(F.broadcast(found), keys, "left")
    return salted_left_join(rows, found, keys, spread, task_rows, hot)


class _Spans:
    """Patterns that begin in one field of a text and end in a later one.

    Fields are joined by a space and neither they nor the patterns have two
    spaces in a row, so such a pattern is an end of a field, whole fields if
    any, and a beginning of a field.  Ends and beginnings are looked up among
    the distinct values, each by its own hash, and only what has both is
    looked for in the texts.  ``values``: (value, places), the places of a
    value as bits; ``patterns``: (text, rule), written."""

    def __init__(self, values: DataFrame, patterns: DataFrame, places: int, task_rows: int):
        self.task_rows, text, at = task_rows, F.col("text"), F.col("at")
        spaces = F.filter(F.sequence(F.lit(1), F.length(text)), lambda i: F.substring(text, i, F.lit(1)) == " ")
        cut = patterns.where(F.instr(text, " ") > 0).select("text", "rule", F.explode(spaces).alias("at"))
        cuts = {"left": (F.substring(text, F.lit(1), at - 1), at - 1), "right": (F.substring(text, at + 1, F.length(text)), F.length(text) - at)}
        self.edges, sides = {}, {}
        for side, (piece, size) in cuts.items():
            pieces = cut.select("text", "rule", "at", F.xxhash64(piece).alias(side))
            edges = values.select("value", "places", F.explode(_edges(cut, size, F.col("value"), side == "left")).alias(side))
            self.edges[side] = materialize(self._known(edges, pieces, side))
            held = self.edges[side].groupBy(side).agg(F.bit_or("places").alias(f"{side}_places"))
            sides[side] = salted_left_join(pieces, held, [side], [text], task_rows).where(F.col(f"{side}_places").isNotNull()).withColumnRenamed("at", f"{side}_at")
        first, last = F.col("left_at"), F.col("right_at")
        middle = F.when(first < last, F.xxhash64(F.substring(text, first + 1, last - first - 1))).otherwise(0)
        both = sides["left"].join(sides["right"].drop("rule"), "text").where(first <= last)

        def spans(i: int, k: int) -> Column:
            return (F.getbit("left_places", F.lit(i)) == 1) & (F.getbit("right_places", F.lit(k)) == 1) & (first == last if k == i + 1 else first < last)

        ways = [*combinations(range(places), 2)]
        wanted = F.array_compact(F.array(*[F.when(spans(i, k), F.lit(n)) for n, (i, k) in enumerate(ways)]))
        self.patterns = materialize(both.select("text", "rule", "left", middle.alias("middle"), "right", wanted.alias("ways")).where(F.size("ways") > 0))
        #: (first place, last place) of the fields that a pattern may span
        self.ways = sorted(ways[r[0]] for r in self.patterns.select(F.explode("ways")).distinct().collect())

    def _known(self, edges: DataFrame, of: DataFrame, side: str) -> DataFrame:
        """The rows of ``edges`` whose piece is one of those of ``of``."""
        known = of.select(side).distinct().withColumn("known", F.lit(True))
        return salted_left_join(edges, known, [side], [F.col("value")], self.task_rows).where("known").drop("known")

    def ends(self, place: int) -> DataFrame:
        """(value): the values in which a pattern may end at ``place``."""
        ends = self.edges["right"].where(F.getbit("places", F.lit(place)) == 1)
        return self._known(ends, self.patterns, "right").select("value").distinct()

    def hits(self, texts: DataFrame, keys: list[str], ways: Sequence[tuple[int, int]]) -> DataFrame:
        """(keys, hit): the least rule of a pattern that spans fields of a row
        of ``texts`` (keys, _0, _1 ...)."""
        def fields(i: int, k: int) -> list[Column]:
            return [F.col(f"_{n}") for n in range(i, k + 1)]

        def span(i: int, k: int) -> Column:
            first, *inner, last = fields(i, k)
            filled = reduce(lambda x, y: x & y, [f != "" for f in fields(i, k)])
            return F.when(filled, F.struct(first.alias("l"), F.concat_ws(" ", *inner).alias("m"), last.alias("r")))

        each = texts.select(*keys, F.explode(F.array_compact(F.array(*[span(i, k) for i, k in ways]))).alias("x")).select(*keys, "x.*")
        distinct = materialize(each.groupBy("l", "m", "r").agg(F.count(F.lit(1)).alias("_n")))
        found, spread = distinct.select("l", "m", "r"), [F.xxhash64("l", "m", "r")]
        for side, field in (("left", "l"), ("right", "r")):
            wanted = self._known(self.edges[side], self.patterns, side)
            lists = materialize(wanted.groupBy(F.col("value").alias(field)).agg(F.collect_set(side).alias(f"{side}s")))
            found = salted_left_join(found, lists, [field], spread, self.task_rows, hot_keys(distinct, [field], self.task_rows)).where(F.col(f"{side}s").isNotNull())
        found = found.withColumn("left", F.explode("lefts")).withColumn("right", F.explode("rights")).drop("lefts", "rights")
        found = materialize(found.withColumn("middle", F.when(F.col("m") == "", 0).otherwise(F.xxhash64("m"))))
        whole = F.concat_ws(" ", "l", F.nullif("m", F.lit("")), "r")
        met = salted_left_join(found, self.patterns.drop("ways"), ["left", "middle", "right"], spread, self.task_rows).where(whole.contains(F.col("text")))
        rules = materialize(met.groupBy("l", "m", "r").agg(F.min("rule").alias("hit")))
        hot = distinct.where(F.col("_n") > self.task_rows).select("l", "m", "r", salts(F.col("_n"), self.task_rows).alias("_salts"))
        back = salted_left_join(each, rules, ["l", "m", "r"], [F.xxhash64(*keys)], self.task_rows, hot)
        return back.where(F.col("hit").isNotNull()).select(*keys, "hit")


def country_by_tables(df: DataFrame, rules: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Add ``country``: tvg-id suffix, keyword unless the tvg-id is locked,
    host suffix, source tag; 'other' when nothing matches.  Needs the columns
    of ``with_normalized``.

    The text of the keywords joins name, group, tvg-name, tvg-id and host.
    Its distinct values are far more than those of its fields, so keywords
    are matched within the distinct fields and, where one spans fields, by
    ``_Spans``.  What an entry says about its channel is looked up under one
    number, its host and tags apart from it."""
    rows, names = _with_raw(df, (*TEXT_FIELDS, "host", "source_tags"))
    channel, origin = [names[f] for f in TEXT_FIELDS], [names["host"], names["source_tags"]]
    last = len(channel)
    # channels, then hosts with their tags, in one pass over the entries
    each = rows.groupingSets([channel, origin], *channel, *origin).agg(F.count(F.lit(1)).alias("_n"))
    fields = {f"_{i}": normalize_text(F.col(c)) for i, c in enumerate([*channel, names["host"]])}
    base = materialize(each.withColumns(fields | {"_tags": normalize_array(F.col(names["source_tags"]))}))
    channels, origins = base.where(F.col(origin[0]).isNull()), base.where(F.col(origin[0]).isNotNull())
    number = _numbered(channels, channel)
    texts = channels.select(number.alias("_key"), F.lower(channel[-1]).alias("_raw"), *[f"_{i}" for i in range(last)], "_n")
    hosts = origins.select(F.col(origin[0]).alias("_raw_host"), f"_{last}").distinct()

    rules = normalized_rules(rules)
    suffixes, keywords, tlds, tags = (_patterns(rules, k) for k in FIELDS)
    locks = rules.where("kind = 'suffix' and value != ''").select(F.lower("value").alias("text"), F.lit(True).alias("rule")).distinct()
    not_blank = F.col("text") != ""
    keywords = materialize(_leading(keywords.where(not_blank)))

    # keywords: within a field, then from one field to another
    placed = texts.select(F.posexplode(F.array(*[f"_{i}" for i in range(last)])).alias("place", "value"))
    placed = placed.unionByName(hosts.select(F.lit(last).alias("place"), F.col(f"_{last}").alias("value"))).where("value != ''")
    bit = reduce(lambda bits, i: F.when(F.col("place") == i, 1 << i).otherwise(bits), range(last + 1), F.lit(0))
    values = materialize(placed.groupBy("value").agg(F.count(F.lit(1)).alias("_n"), F.bit_or(bit).alias("places")))
    within = materialize(_first(matching(values.select("value"), keywords, False, task_rows), "hit"))
    spans = _Spans(values, keywords, last + 1, task_rows)
    held = texts.select("_key", F.explode(F.array_distinct(F.array(*[f"_{i}" for i in range(last)]))).alias("value")).where("value != ''")
    hot = values.where(F.col("_n") > task_rows).select("value", salts(F.col("_n"), task_rows).alias("_salts"))
    hits = salted_left_join(held, within, ["value"], [F.col("_key")], task_rows, hot).where("hit is not null").select("_key", "hit")
    if inner := [(i, k) for i, k in spans.ways if k < last]:
        hits = hits.unionByName(spans.hits(texts, ["_key"], inner))
    by_text = materialize(hits.groupBy("_key").agg(F.min("hit").alias("by_text")))

    # suffixes and locks, of the tvg-ids that are not blank
    ids = texts.where(F.col(f"_{last - 1}") != "").select("_key", F.col(f"_{last - 1}").alias("_id"), "_raw")
    by_id = materialize(_first(matching(_distinct(ids, F.col("_id")), _leading(suffixes.where(not_blank), "last"), True, task_rows), "by_id").withColumnRenamed("value", "_id"))
    locked = materialize(matching(_distinct(ids, F.col("_raw")), locks, False, task_rows).select(F.col("value").alias("_raw"), F.lit(True).alias("locked")).distinct())
    blank = _leading(suffixes.where(~not_blank), "last").agg(F.min("rule")).scalar()
    ids = salted_left_join(ids, by_id, ["_id"], [F.col("_key")], task_rows, hot_keys(ids, ["_id"], task_rows))
    ids = salted_left_join(ids, locked, ["_raw"], [F.col("_key")], task_rows, hot_keys(ids, ["_raw"], task_rows))
    # a suffix that normalises to nothing ends every tvg-id
    ids = ids.select("_key", F.least("by_id", blank)["r"].alias("by_id"), F.coalesce("locked", F.lit(False)).alias("locked"))
    by_channel = materialize(ids.where("by_id is not null or locked").join(by_text, "_key", "full"))

    # hosts and tags
    by_host = materialize(_first(matching(_distinct(hosts, F.col("_raw_host")), _leading(tlds.where(not_blank)), True, task_rows), "by_host").withColumnRenamed("value", "_raw_host"))
    in_host = within.select(F.col("value").alias(f"_{last}"), F.col("hit").alias("in_host"))
    hosts = salted_left_join(hosts, in_host, [f"_{last}"], [F.col("_raw_host")], task_rows).drop(f"_{last}")
    hosts = materialize(hosts.join(by_host, "_raw_host", "left").where("in_host is not null or by_host is not null").select("_raw_host", "in_host", F.col("by_host.r").alias("by_host")))
    by_tag = materialize(_tag_rules(origins, _leading(tags), F.min("rule")))
    listed = origins.select(origin[1], "_tags").distinct()
    by_tag = materialize(salted_left_join(listed, by_tag, ["_tags"], [F.xxhash64(origin[1])], task_rows).where("found is not null").select(origin[1], F.col("found.r").alias("by_tag")))

    spread = [F.col(c) for c, kind in df.dtypes if not kind.startswith("map") and c not in NORMAL.values()]
    rows = rows.withColumn("_key", number).drop(*channel)
    rows = _looked_up(rows, hosts, [origin[0]], spread, task_rows)
    rows = _looked_up(rows, by_tag, [origin[1]], spread, task_rows).drop(origin[1])
    texts_hit = [F.col("by_text"), F.col("in_host")]
    if outer := [(i, k) for i, k in spans.ways if k == last]:
        # a keyword that begins in the channel and ends in the host
        reached = origins.select(origin[0], F.col(f"_{last}").alias("value")).distinct().join(spans.ends(last), "value", "left_semi")
        reached = materialize(reached.withColumnRenamed("value", f"_{last}"))
        met = _looked_up(rows, reached, [origin[0]], spread, task_rows).where(F.col(f"_{last}").isNotNull())
        met = materialize(met.select("_key", origin[0], f"_{last}").distinct())
        met = salted_left_join(met, texts.drop("_raw", "_n"), ["_key"], [F.col(origin[0])], task_rows)
        across = spans.hits(met, ["_key", origin[0]], outer).groupBy("_key", origin[0]).agg(F.min("hit").alias("across"))
        rows = _looked_up(rows, materialize(across), ["_key", origin[0]], spread, task_rows)
        texts_hit.append(F.col("across"))
    hot = channels.where(F.col("_n") > task_rows).select(number.alias("_key"), salts(F.col("_n"), task_rows).alias("_salts"))
    rows = _looked_up(rows.drop(origin[0]), by_channel, ["_key"], spread, task_rows, hot)
    text = F.when(~F.coalesce("locked", F.lit(False)), F.least(*texts_hit)["r"])
    return rows.select(*df.columns, F.coalesce("by_id", text, "by_host", "by_tag", F.lit("other")).alias("country"))


def categories_by_tables(df: DataFrame, rules: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Add ``categories``: sorted distinct ids of every rule with a keyword in
    name, group and tvg-name or one of the tags; ['general'] when none."""
    inputs = {"_text": F.concat_ws(" ", "norm_name", "norm_group", "norm_tvg_name"), "_tags": F.col("norm_tags")}
    rows, base, keys = _inputs(df, ("name", "group_title", "tvg-name", "source_tags"), inputs)
    rules = normalized_rules(rules)

    def owners(patterns: DataFrame) -> DataFrame:
        return patterns.groupBy("text").agg(F.collect_set("rule_id").alias("rule"))

    keywords, tags = _patterns(rules, "keyword"), _patterns(rules, "tag")
    pairs = matching(_distinct(base, F.col("_text")), owners(keywords.where("text != ''")), False, task_rows)
    ids = pairs.select("value", F.explode("rule").alias("id")).distinct()
    by_text = materialize(ids.groupBy(F.col("value").alias("_text")).agg(F.collect_list("id").alias("by_text")))
    by_tag = materialize(_tag_rules(base, owners(tags.where("text != ''")), F.flatten(F.collect_set("rule")))).withColumnRenamed("found", "by_tag")
    each = _attach(_attach(base, base, by_text, ["_text"], task_rows), base, by_tag, ["_tags"], task_rows)
    none = _no_ids()
    found = F.array_sort(F.array_distinct(F.concat(F.coalesce("by_text", none), F.coalesce("by_tag", none))))
    each = each.select(*keys, F.when(F.size(found) == 0, F.array(F.lit("general"))).otherwise(found).alias("categories"))
    return _back(df, rows, each, base, keys, task_rows)


def classify_by_tables(df: DataFrame, countries: DataFrame, categories: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """``classify`` with rule tables instead of a profile's rules."""
    if "norm_name" not in df.columns:
        df = with_normalized(df)
    return categories_by_tables(country_by_tables(df, countries, task_rows), categories, task_rows)


def content_filter_by_table(df: DataFrame, keywords: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Rows without any of the keywords (as given, not normalised) in their
    normalised name or group.  ``keywords``: rows of kind 'keyword'."""
    rows, base, keys = _inputs(df, ("name", "group_title"), {"_name": F.col("norm_name"), "_group": F.col("norm_group")})
    values = base.select(F.explode(F.array("_name", "_group")).alias("value")).where("value != ''").distinct()
    texts = keywords.where("kind = 'keyword'").select(F.col("value").alias("text"), F.lit(True).alias("rule")).distinct()
    hits = materialize(matching(values, texts.where("text != ''"), False, task_rows).select("value").distinct())
    each = base
    for column in ("_name", "_group"):
        each = _attach(each, base, hits.select(F.col("value").alias(column), F.lit(True).alias(f"hit{column}")), [column], task_rows)
    # an empty keyword is in every text
    blank = texts.where("text = ''").agg(F.count(F.lit(1))).scalar() > 0
    each = each.select(*keys, (F.coalesce("hit_name", "hit_group", F.lit(False)) | blank).alias("_unwanted"))
    return _back(df, rows, each, base, keys, task_rows).where(~F.col("_unwanted")).drop("_unwanted")
