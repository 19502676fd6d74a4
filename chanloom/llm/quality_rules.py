"""Quality rules by weak supervision.

Eleven rules vote good (1) or bad (0) on every document, or abstain (-1).
Expectation-maximisation over the vote patterns estimates how often each rule
is right about good and about bad documents, and a document is kept by its
posterior probability of being good instead of having to pass every rule.

One pass over the texts (no shuffle) measures the documents and takes the
votes; what is written is one narrow row a document.  The pattern counts are
one row a pattern, at most 3^11 = 177,147 whatever the corpus, so the
expectation-maximisation runs on the driver.  The posterior is a Column.

Windows, lines and words are compared by 64-bit hashes inside one document.

Defined cases: a null text is empty; empty texts have no words, every rule
abstains and the base rules fail them.  Whole texts are measured, however
long.  Rows that repeat get the same result each.  An empty table gives no
rows.  Other columns of the input play no part, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanloom.llm.common import materialize, offsets, text_batches, text_of, tidy, worker_cache
from chanloom.llm.strings import codepoints, is_ws, mix, piece_hashes, word_spans

BATCH_CHARS = 500_000
WINDOW = 8
#: Words of a run in which different words are counted.
RUN = 50
SYMBOLS = "#*$%&|<>"
#: Frequent small words of four languages, as fixed values.
SMALL_WORDS = """the of and to in is that it was for on are as with his they
der die das und in den von zu mit sich des auf ist im dem nicht ein eine
le la les de des et en un une du que est pour dans par sur
el los las y en un una que del por con se para""".split()
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RULES = ["v_size", "v_word_size", "v_symbols", "v_lines", "v_windows", "v_capitals", "v_stutter", "v_top_word", "v_variety", "v_letters", "v_marks"]
ROUNDS = 50
#: A rule is taken to be right more often than not.
LEAST, MOST = 0.55, 0.9995
KEEP = 0.5


def _marked(pattern: str, name: str) -> np.ndarray:
    """Which code points match a character class."""
    cache = worker_cache()
    held = getattr(cache, "marked", None)
    if held is None:
        held = cache.marked = {}
    if name not in held:
        import regex

        every = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
        found = np.zeros(0x110000, bool)
        for m in regex.finditer(pattern + "+", every):
            a, b = m.span()
            found[a + (0x800 if a >= 0xD800 else 0): b + (0x800 if b > 0xD800 else 0)] = True
        held[name] = found
    return held[name]


def _small_words() -> np.ndarray:
    codes, at = codepoints(SMALL_WORDS)
    return np.unique(piece_hashes(codes, at[:-1], at[1:]))


def _per_doc(flags: np.ndarray, docs: np.ndarray) -> np.ndarray:
    return np.diff(offsets(flags)[docs])


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Which elements occur more than once."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def measured(texts: list[str]) -> dict[str, np.ndarray]:
    """Measures of every text: those of MEASURES, and those that rules use."""
    codes, docs = codepoints(texts)
    n_docs = len(texts)
    blank = is_ws(codes)
    starts, ends, doc = word_spans(blank, docs)
    sizes = ends - starts
    count = lambda of, weights=None: np.bincount(of, weights, minlength=n_docs).astype(np.int64)
    m = {"n_words": count(doc), "word_chars": count(doc, sizes), "n_symbols": _per_doc(np.isin(codes, [ord(c) for c in SYMBOLS]), docs)}
    words = piece_hashes(codes, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    own = mix(doc.astype(np.uint64))

    # words in windows that the text has twice
    covered = np.zeros(len(words) + 1, np.int64)
    if len(words) >= WINDOW:
        inside = np.flatnonzero(doc[: len(doc) - WINDOW + 1] == doc[WINDOW - 1:])
        window = own[inside].copy()
        for k in range(WINDOW):
            window = mix(window * np.uint64(0x9E3779B97F4A7C15) + words[inside + k])
        twice = inside[_repeats(window)]
        covered[twice] += 1
        covered[twice + WINDOW] -= 1
    m["n_repeat_words"] = count(doc[np.cumsum(covered)[:-1] > 0])

    # lines with a word
    edge = np.flatnonzero(codes == 0x0A)
    line_doc = np.concatenate([np.arange(n_docs), np.searchsorted(docs, edge, side="right") - 1])
    line_start = np.concatenate([docs[:-1], edge + 1])
    order = np.lexsort((line_start, line_doc))
    line_doc, line_start = line_doc[order], line_start[order]
    line_end = np.append(line_start[1:] - 1, len(codes))
    last = np.append(line_doc[1:] != line_doc[:-1], True)
    line_end[last] = docs[1:][line_doc[last]]
    solid = offsets(~blank)
    full = solid[line_end] > solid[line_start]
    line_doc, line_start, line_end = line_doc[full], line_start[full], line_end[full]
    m["n_lines"] = count(line_doc)
    if len(line_doc):
        key = mix(piece_hashes(codes, line_start, line_end) ^ mix(line_doc.astype(np.uint64)))
        first = np.unique(key, return_index=True)[1]
        m["n_dup_lines"] = m["n_lines"] - count(line_doc[first])
    else:
        m["n_dup_lines"] = np.zeros(n_docs, np.int64)

    # what only rules use
    upper, cased = _marked(r"\p{Lu}", "upper")[codes], _marked(r"[\p{Lu}\p{Ll}]", "cased")[codes]
    m["upper"], m["cased"] = _per_doc(upper, docs), _per_doc(cased, docs)
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    m["stutters"] = count(doc[again])
    key, first, times = np.unique(mix(words ^ own), return_index=True, return_counts=True)
    m["top_word"] = np.zeros(n_docs, np.int64)
    np.maximum.at(m["top_word"], doc[first], times)
    first_word = np.searchsorted(doc, np.arange(n_docs))
    runs = (np.arange(len(doc)) - first_word[doc]) // RUN
    first = np.unique(mix(words ^ mix(own + runs.astype(np.uint64))), return_index=True)[1]
    m["run_words"] = count(doc[first])  # different words of each run
    letters = offsets(_marked(r"[\p{L}\p{M}]", "letters")[codes])
    m["with_letter"] = count(doc[letters[ends] > letters[starts]])
    m["small_words"] = count(doc[np.isin(words, _small_words())])
    mark = _marked(r"[\p{P}\p{S}]", "marks")[codes]
    pair = np.zeros(len(codes) + 1, bool)
    pair[1:-1] = mark[1:] & mark[:-1]  # at the second of two
    pairs = offsets(pair)
    m["with_marks"] = count(doc[pairs[ends] > pairs[np.minimum(starts + 1, ends)]])
    return m


def votes(m: dict[str, np.ndarray]) -> np.ndarray:
    """Votes of all rules, a row a text."""
    n = np.maximum(m["n_words"], 1)
    some = m["n_words"] > 0

    def rule(good, bad, applies):
        return np.where(~applies, -1, np.where(bad, 0, np.where(good, 1, -1))).astype(np.int8)

    size = m["word_chars"] / n
    symbols, lines, windows = m["n_symbols"] / n, m["n_dup_lines"] / np.maximum(m["n_lines"], 1), m["n_repeat_words"] / n
    capitals, stutter, top = m["upper"] / np.maximum(m["cased"], 1), m["stutters"] / n, m["top_word"] / n
    variety = m["run_words"] / n
    letters, marks, small = m["with_letter"] / n, m["with_marks"] / n, m["small_words"] / n
    return np.stack([
        rule((m["n_words"] >= 50) & (small >= 0.01), m["n_words"] < 20, some),
        rule((size >= 3) & (size <= 10), (size < 2) | (size > 20), some),
        rule(symbols <= 0.02, symbols > 0.1, some),
        rule(lines <= 0.1, lines > 0.3, m["n_lines"] >= 4),
        rule(windows <= 0.1, windows > 0.3, m["n_words"] >= 2 * WINDOW),
        rule(capitals <= 0.2, capitals > 0.5, m["cased"] >= 20),
        rule(stutter <= 0.02, stutter > 0.2, m["n_words"] >= 5),
        rule(top <= 0.15, top > 0.3, m["n_words"] >= 20),
        rule(variety >= 0.5, variety < 0.3, m["n_words"] >= 20),
        rule(letters >= 0.8, letters < 0.6, some),
        rule(marks <= 0.1, marks > 0.3, some),
    ], axis=1)


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[float, np.ndarray]:
    """Expectation-maximisation: the share of good documents and, for each
    rule, how often its votes are right about good and about bad ones."""
    said, good_vote = patterns >= 0, patterns == 1
    against = (patterns == 0).sum(axis=1)
    belief = np.where(against == 0, 0.95, np.where(against == 1, 0.5, 0.05))
    prior, right = 0.5, np.full((patterns.shape[1], 2), 0.8)
    for _ in range(rounds):
        good, bad = counts * belief, counts * (1 - belief)
        prior = (good.sum() + 1) / (counts.sum() + 2)
        for k in range(patterns.shape[1]):
            on = said[:, k]
            yes, no = good_vote[:, k], on & ~good_vote[:, k]
            right[k] = ((good[yes].sum() + 4) / (good[on].sum() + 5), (bad[no].sum() + 4) / (bad[on].sum() + 5))
        right = np.clip(right, (LEAST, 1e-4), (MOST, MOST))
        belief = 1 / (1 + np.exp(-_log_odds(patterns, prior, right)))
    return float(prior), right


def _weights(right: np.ndarray) -> np.ndarray:
    """Log odds that a good vote and a bad vote add."""
    return np.stack([np.log(right[:, 0] / (1 - right[:, 1])), np.log((1 - right[:, 0]) / right[:, 1])], axis=1)


def _log_odds(patterns: np.ndarray, prior: float, right: np.ndarray) -> np.ndarray:
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    w = _weights(right)
    return np.log(prior / (1 - prior)) + np.where(patterns == 1, w[:, 0], np.where(patterns == 0, w[:, 1], 0.0)).sum(axis=1)


def posterior(prior: float, right: np.ndarray) -> Column:
    """P(good | votes)."""
    prior = min(max(prior, 1e-6), 1 - 1e-6)
    odds = F.lit(float(np.log(prior / (1 - prior))))
    for rule, (good, bad) in zip(RULES, _weights(right).tolist()):
        odds = odds + F.when(F.col(rule) == 1, good).when(F.col(rule) == 0, bad).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def _measure_rows(batches):
    names = ["doc_id", *MEASURES, *RULES]
    for batch in batches:
        for a, b, part in text_batches(batch, "text", BATCH_CHARS):
            m = measured(part)
            v = votes(m)
            columns = [batch.column("doc_id").slice(a, b - a), *[pa.array(m[c], pa.int64()) for c in MEASURES], *[pa.array(v[:, k], pa.int8()) for k in range(len(RULES))]]
            yield pa.RecordBatch.from_arrays(columns, names)


def voted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the measures and the rules' votes of every document."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_of(docs, text).alias("text"))
    schema = ", ".join(["doc_id long", *[f"{c} long" for c in MEASURES], *[f"{r} tinyint" for r in RULES]])
    return rows.mapInArrow(tidy(_measure_rows), schema)


def trained(rows: DataFrame) -> tuple[float, np.ndarray]:
    """Reliabilities from the vote patterns of all documents."""
    found = rows.groupBy(*RULES).agg(F.count(F.lit(1)).alias("n")).orderBy(*RULES).collect()  # at most 3^11 rows
    table = np.array([[r[c] for c in [*RULES, "n"]] for r in found], np.int64).reshape(len(found), len(RULES) + 1)
    return reliabilities(table[:, :-1], table[:, -1].astype(np.float64))


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, the measures, base_failed, kept, and
    the posterior with the votes behind it."""
    rows = materialize(voted(docs, key, text), "votes")
    prior, right = trained(rows)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = rows.withColumns({"base_failed": failed, "posterior": posterior(prior, right)})
    kept = ~F.col("base_failed") & (F.col("posterior") >= KEEP)
    return rows.withColumn("kept", kept).select("doc_id", *MEASURES, "base_failed", "kept", "posterior", *RULES)
