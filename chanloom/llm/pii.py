"""Personal data by weak supervision (native).

1. Base spans: four kinds by regular expression and check, always reported.
2. Candidates: the base patterns' matches (also those that fail their check)
   and looser patterns (card numbers beside other digits, phone numbers
   without a country code, secrets).
3. Labelers vote 1, 0 or not at all (-1) on every candidate: pattern, check,
   gazetteer, context words, boundaries.
4. Expectation-maximisation over the vote patterns (a table bounded by
   kinds x 3^labelers) estimates each labeler's reliability and every
   candidate's posterior.
5. A naive Bayes span classifier is trained on the posteriors with features
   of the span itself; candidates it accepts that meet no other span are added.

Matches and the gaps between them give positions by a running sum, so texts
are scanned where they are stored and only short spans are shuffled.
Possessive repeats keep every pattern linear and free of deep recursion on
long texts.

Defined cases: a null text is empty; whole texts are searched, however long;
rows that repeat doc_id and text get the same result each; a table without
candidates has no spans, an empty one gives no rows; other columns of the
input play no part, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanloom.llm.common import materialize, text_of
from chanloom.llm.weighted_sampling import KEY, _key

KINDS = ("email", "ip", "card", "phone", "secret")
BASE = KINDS[:4]
#: The contract's patterns, with possessive repeats; a look-behind keeps the
#: first ones from starting inside a run that has failed already.
BASE_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE_PATTERNS = {
    "card": r"(?<![0-9A-Za-z])[0-9]{12,19}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+)])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
    "secret": r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,64}(?![0-9A-Za-z])",
}
#: What a text must contain before a pattern is tried.
TRIGGER = {"email": "@", "ip": ".", "card": None, "phone": None, "secret": None}
OCTET = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$"
#: Gazetteers, as fixed values: ends of mail domains, issuer prefixes of card
#: numbers, reserved address blocks, assigned calling codes.
MAIL_ENDS = """com org net edu gov mil int io co info biz name dev app eu ar at au be bg br by ca ch cl cn cz de dk ee es fi fr gr hk hr hu id ie il in is it
jp kr lt lu lv mx my nl no nz pe ph pl pt ro rs ru se sg si sk th tr tw ua uk us vn za""".split()
ISSUERS = r"^(?:4|5[1-5]|2(?:22[1-9]|2[3-9][0-9]|[3-6][0-9]{2}|7[01][0-9]|720)|3[47]|6(?:011|4[4-9]|5)|35(?:2[89]|[3-8])|3(?:0[0-5]|[689])|62)"
RESERVED = r"^0*(?:0|10|127|2(?:2[4-9]|[345][0-9])|192\.0*168|169\.0*254|172\.0*(?:1[6-9]|2[0-9]|3[01]))\."
CALLING = r"^\+(?:1|7|2(?:0|7|[1-689][0-9])|3(?:[0-469]|[578][0-9])|4(?:[013-9]|2[013])|5(?:[1-8]|0[0-9]|9[0-9])|6(?:[0-6]|[7-9][0-9])|8(?:[1246]|5[0-9]|80)|9(?:[0-58]|[679][0-9]))"
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|contact|write|reach|correo|courriel|adresse)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|addr|login)\b",
    "card": r"(?i)\b(?:card|visa|credit|payment|karte|carte|tarjeta)\b",
    "phone": r"(?i)\b(?:tel|phone|call|mobile|fax|telefon|t.l.phone|tel.fono)\b",
    "secret": r"(?i)\b(?:token|key|secret|password|passwd|auth|credential)s?\b",
}
LABELERS = ["v_pattern", "v_check", "v_gazetteer", "v_context", "v_boundary"]
FEATURES = ["f_size", "f_digits", "f_first", "f_context", "f_before", "f_after", "f_check"]
ROUNDS = 12
ACCEPT = 0.9
#: Code points of context on each side of a span (up to the match beyond the
#: nearest one).
NEAR = 80


def _luhn(digits: Column) -> Column:
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    doubled = F.transform(F.filter(numbers, lambda d: d.isNotNull()), lambda d, i: F.when(i % 2 == 0, d).when(d * 2 > 9, d * 2 - 9).otherwise(d * 2))
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + d) % 10 == 0


def _valid(kind: Column, span: Column) -> Column:
    digits = F.regexp_replace(span, "[^0-9]", "")
    n = F.length(digits)
    return (F.when(kind == "email", F.lit(True)).when(kind == "ip", span.rlike(OCTET))
            .when(kind == "card", n.between(12, 19) & _luhn(F.left(digits, F.lit(20))))
            .when(kind == "phone", n.between(9, 15)).otherwise(span.rlike("[0-9]") & span.rlike("[A-Za-z]")))


def matches(rows: DataFrame) -> DataFrame:
    """(KEY, kind, base, start, end, span, before, after): every match of
    every pattern, once for rows that repeat."""
    found = []
    for base, patterns in ((True, BASE_PATTERNS), (False, LOOSE_PATTERNS)):
        for kind, pattern in patterns.items():
            tried = F.col("text").contains(TRIGGER[kind]) if TRIGGER[kind] else F.lit(True)
            # a text without digits has no match but of the first pattern
            tried = tried if kind == "email" else tried & F.col("text").rlike("[0-9]")
            spans = F.when(tried, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
            gaps = F.when(F.size(spans) > 0, F.split("text", pattern, -1))
            found.append(F.struct(F.lit(kind).alias("kind"), F.lit(base).alias("base"), spans.alias("spans"), gaps.alias("gaps")))
    hits = rows.where(F.col("text").rlike("[0-9@]")).select(*KEY, F.explode(F.array(*found)).alias("m")).where(F.size("m.spans") > 0)
    none = F.array(F.lit(""))
    spans, gaps, n = F.col("m.spans"), F.col("m.gaps"), F.size("m.spans")
    # each span with the gap on each side, the spans beside those and the gaps beyond
    hits = hits.select(*KEY, "m.kind", "m.base", F.posexplode(F.arrays_zip(
        spans.alias("span"), gaps.alias("gap"), F.slice(gaps, 2, n).alias("next"), F.concat(none, spans).alias("span_0"), F.concat(none, gaps).alias("gap_0"),
        F.concat(F.slice(spans, 2, n), none).alias("span_2"), F.concat(F.slice(gaps, 3, n), none).alias("gap_2"))).alias("pos", "s"))
    hits = hits.where(F.col("s.span").isNotNull())
    wide = F.lit(NEAR)
    hits = hits.select(*KEY, "kind", "base", "pos", F.col("s.span").alias("span"), F.length("s.gap").cast("long").alias("skip"),
                       F.right(F.concat(F.right("s.gap_0", wide), F.right("s.span_0", wide), F.right("s.gap", wide)), wide).alias("before"),
                       F.left(F.concat(F.left("s.next", wide), F.left("s.span_2", wide), F.left("s.gap_2", wide)), wide).alias("after"))
    hits = hits.dropDuplicates([*KEY, "kind", "base", "pos"])
    run = Window.partitionBy(*KEY, "kind", "base").orderBy("pos")
    size = F.length("span").cast("long")
    end = F.sum(F.col("skip") + size).over(run)
    return hits.select(*KEY, "kind", "base", (end - size).alias("start"), end.alias("end"), "span", "before", "after")


def votes(hits: DataFrame) -> DataFrame:
    """Labelers' votes and span features of every candidate."""
    kind, span = F.col("kind"), F.col("span")
    vote = lambda c: F.when(c, 1).otherwise(0)
    digits = F.length(F.regexp_replace(span, "[^0-9]", ""))
    context = F.lit(False)
    for k, words in CONTEXT.items():
        context = F.when(kind == k, F.col("before").rlike(words) | F.coalesce(F.col("after"), F.lit("")).rlike(words)).otherwise(context)
    listed = (F.when(kind == "email", vote(F.lower(F.substring_index(span, ".", -1)).isin(MAIL_ENDS)))
              .when(kind == "card", vote(F.regexp_replace(span, "[^0-9]", "").rlike(ISSUERS)))
              .when(kind == "ip", vote(~span.rlike(RESERVED)))
              .when(kind == "phone", vote(span.rlike(CALLING)))
              .otherwise(F.lit(-1)))
    behind = F.left(F.coalesce(F.col("after"), F.lit("")), F.lit(1))
    alone = ~F.right("before", F.lit(1)).rlike("[0-9A-Za-z]") & ~behind.rlike("[0-9A-Za-z]")
    rows = hits.withColumn("valid", F.coalesce(_valid(kind, span), F.lit(False)))
    rows = rows.withColumn("is_base", F.col("base") & F.col("valid"))
    rows = rows.withColumns({
        "v_pattern": F.when(F.col("base"), 1).otherwise(F.when(kind == "secret", -1).otherwise(0)),
        "v_check": vote(F.col("valid")),
        "v_gazetteer": listed,
        "v_context": F.when(context, 1).otherwise(-1),
        "v_boundary": vote(alone),
    })
    edge = lambda c: F.when(c.rlike("[0-9]"), "digit").when(c.rlike("[A-Za-z]"), "letter").when(c == "", "none").otherwise("other")
    named = lambda c: F.concat_ws("/", kind, c.cast("string"))
    return rows.withColumns({
        "f_size": named(F.least(F.length(span), F.lit(64))),
        "f_digits": named(F.floor(digits * 8 / F.length(span))),
        "f_first": named(F.when(F.left(span, F.lit(1)).rlike("[0-9]"), "digit").when(F.left(span, F.lit(1)).rlike("[A-Za-z]"), "letter").otherwise("other")),
        "f_context": named(context),
        "f_before": named(edge(F.right("before", F.lit(1)))),
        "f_after": named(edge(behind)),
        "f_check": named(F.col("valid")),
    })


def posterior(prior: float, rates: dict[str, tuple[float, float]]) -> Column:
    """P(personal | votes) under independent labelers; rates: P(vote 1) for
    true and for false candidates."""
    odds = F.log(F.lit(prior / (1 - prior)))
    for v, (yes, no) in rates.items():
        odds = odds + F.when(F.col(v) == 1, F.log(F.lit(yes / no))).when(F.col(v) == 0, F.log(F.lit((1 - yes) / (1 - no)))).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def reliabilities(voted: DataFrame, rounds: int = ROUNDS) -> tuple[float, dict[str, tuple[float, float]]]:
    """Expectation-maximisation over the counts of vote patterns, from
    majority votes.  Only the parameters come to the driver."""
    patterns = materialize(voted.groupBy(*LABELERS).agg(F.count(F.lit(1)).alias("n")).coalesce(1), "patterns")
    said = sum((F.when(F.col(v) >= 0, 2 * F.col(v) - 1).otherwise(0) for v in LABELERS), F.lit(0))
    belief = F.when(said > 0, 0.9).otherwise(0.1)
    prior, rates = 0.5, {}
    for _ in range(rounds):
        true, false = F.col("n") * F.col("p"), F.col("n") * (1 - F.col("p"))
        sums = [F.sum(true).alias("t"), F.sum("n").alias("all")]
        for v in LABELERS:
            sums += [F.sum(F.when(F.col(v) == 1, true)).alias(f"{v}_t1"), F.sum(F.when(F.col(v) >= 0, true)).alias(f"{v}_t"),
                     F.sum(F.when(F.col(v) == 1, false)).alias(f"{v}_f1"), F.sum(F.when(F.col(v) >= 0, false)).alias(f"{v}_f")]
        got = patterns.withColumn("p", belief).agg(*sums).first().asDict()
        got = {k: float(x or 0) for k, x in got.items()}
        prior = (got["t"] + 1) / (got["all"] + 2)
        rates = {v: ((got[f"{v}_t1"] + 1) / (got[f"{v}_t"] + 2), (got[f"{v}_f1"] + 1) / (got[f"{v}_f"] + 2)) for v in LABELERS}
        belief = posterior(prior, rates)
    return prior, rates


def classified(voted: DataFrame, prior: float, rates: dict) -> DataFrame:
    """``voted`` with chance: the naive Bayes span classifier's probability,
    trained on the posteriors of all candidates."""
    rows = voted.withColumn("belief", posterior(prior, rates))
    long = rows.select(F.explode(F.array(*[F.concat(F.lit(f + "="), F.col(f)) for f in FEATURES])).alias("feature"), "belief")
    table = long.groupBy("feature").agg(F.sum("belief").alias("yes"), F.sum(1 - F.col("belief")).alias("no"))
    yes, no = (float(x or 0) for x in rows.agg(F.sum("belief"), F.sum(1 - F.col("belief"))).first())
    # one row per feature, kind and value: fewer than 7 * 5 * 65 whatever the corpus
    weights = F.broadcast(table.select("feature", (F.log((F.col("yes") + 0.5) / (yes + 1)) - F.log((F.col("no") + 0.5) / (no + 1))).alias("weight")))
    own = [*KEY, "kind", "start", "end", "is_base"]
    each = rows.select(*own, F.explode(F.array(*[F.concat(F.lit(f + "="), F.col(f)) for f in FEATURES])).alias("feature"))
    scored = each.join(weights, "feature").groupBy(*own).agg((F.sum("weight") + math.log((yes + 1) / (no + 1))).alias("odds"))
    return scored.withColumn("chance", 1 / (1 + F.exp(-F.col("odds")))).drop("odds")


def chosen(scored: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """All base spans, and accepted candidates that meet none of them and no
    earlier accepted one."""
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    rows = scored.where(F.col("is_base") | (F.col("chance") >= accept)).withColumn("rank", order)
    doc = Window.partitionBy(*KEY)
    before = doc.orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    later = doc.orderBy("start").rangeBetween(0, Window.unboundedFollowing)
    rows = rows.withColumn("base_end", F.max(F.when(F.col("is_base"), F.col("end"))).over(before))
    rows = rows.withColumn("base_next", F.min(F.when(F.col("is_base"), F.col("start"))).over(later))
    free = (F.coalesce("base_end", F.lit(0)) <= F.col("start")) & (F.col("base_next").isNull() | (F.col("base_next") >= F.col("end")))
    rows = rows.where(F.col("is_base") | free)
    earlier = doc.orderBy("start", "rank", "end").rowsBetween(Window.unboundedPreceding, -1)
    last = F.max(F.when(~F.col("is_base"), F.col("end"))).over(earlier)
    return rows.withColumn("last", last).where(F.col("is_base") | F.col("last").isNull() | (F.col("last") <= F.col("start"))).drop("last", "base_end", "base_next")


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone,
    base_sha256, spans, n_added."""
    whole = text_of(docs, text)
    rows = docs.select(*_key(F.col(key), whole), whole.alias("text"))
    voted = materialize(votes(matches(rows)), "votes")
    spans = chosen(classified(voted, *reliabilities(voted)))
    name = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string"))
    item = F.struct("start", "rank", "end", name.alias("name"))
    listed = lambda c: F.array_join(F.transform(F.sort_array(F.collect_list(c)), lambda s: s["name"]), ",")
    per = spans.groupBy(*KEY).agg(
        *[F.sum((F.col("is_base") & (F.col("kind") == k)).cast("long")).alias(f"n_{k}") for k in BASE],
        listed(F.when(F.col("is_base"), item)).alias("base"), listed(item).alias("spans"), F.sum((~F.col("is_base")).cast("long")).alias("n_added"))
    every = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("times")).join(per, KEY, "left")
    every = every.withColumn("copy__", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return every.select(F.when(~F.col("k_none"), F.col("k_id")).alias("doc_id"), *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in BASE],
                        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"), F.coalesce("n_added", F.lit(0).cast("long")).alias("n_added"))
