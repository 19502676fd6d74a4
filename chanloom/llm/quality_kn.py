"""Quality classifier: interpolated modified Kneser-Ney model of trusted text.

The model predicts a document's symbols (characters and an end mark of each
word) from the four symbols before them, which may lie in earlier words.  A
word that equals its predecessor, or ends a phrase of PHRASE words that its
document has had before, is one REPEAT symbol; any other is marked NEW.
Steps, all distributed:

1. ``count_grams``: 5-gram counts of trusted text, pre-aggregated per task.
2. Documents are packed into chunks of a fixed size; every chunk asks for the
   distinct 5-grams it holds.
3. ``gram_log_probabilities``: counts, context sums and the distinct requests
   are sharded by gram and joined order by order (five small left joins);
   counts of each order and the discounts of all orders are made once.
4. Every chunk gets its grams' log probabilities back and scores its
   documents; perplexity = exp(-log probability per symbol).
   A gram is looked up by a 64-bit key: its five code points where all are
   below 4,096, a hash otherwise.
5. Per language, a document whose (length-shrunk) perplexity is above a
   quantile of held-out trusted documents is rejected.

Defined cases: a null or empty text has no symbols and gets its language's
mean; languages compare null-safely; a language with fewer than
``min_trusted`` held-out trusted documents uses the quantile of all of them;
without any trusted text nothing is rejected; repeated rows score alike;
whole texts are scored, however long; an empty table gives no rows; other
columns of the input play no part, whatever their names.
Chunks are rebuilt for the second pass, so ``docs`` must be a stored table
(a scan); a chunk whose content changed between passes fails the job.
"""

from __future__ import annotations

import hashlib
import io
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chanloom.llm.common import materialize, offsets, ranges, text_batches, tidy
from chanloom.llm.strings import codepoints, is_ws, mix, piece_hashes, word_spans

ORDER = 5
START, END, REPEAT, NEW, REPLACED = 2, 3, 4, 5, 0xFFFD
#: Words of a phrase whose return in a document counts as a repeat.
PHRASE = 4
#: Code points of one chunk (a longer document is a chunk of its own).
CHUNK_CHARS = 32_000_000
#: Code points that numpy handles at once.
BATCH_CHARS = 500_000
#: Keys that a task holds apart before it merges them.
MERGE_KEYS = 1_000_000
#: Bits of a code point in the key of a gram.
NARROW = 12
#: Digits of a log probability on its way to the chunk that asked.
DIGITS = 8
HASHED = np.uint64(1) << np.uint64(63)


def _as_strings(grams: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(grams, dtype=np.uint32).view(f"<U{ORDER}").ravel()


#: The grams that mark a word which repeats, and one that does not.
REPEAT_GRAM, NEW_GRAM = [START] * (ORDER - 1) + [REPEAT], [START] * (ORDER - 1) + [NEW]


def gram_keys(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of grams given as one array per place, and which are hashed."""
    key = np.zeros(len(columns[0]), np.uint64)
    wide = np.zeros(len(key), bool)
    for c in columns:
        key <<= np.uint64(NARROW)
        key |= c.astype(np.uint64)
        wide |= c >= 1 << NARROW
    if wide.any():
        h = np.zeros(int(wide.sum()), np.uint64)
        for c in columns:
            h = mix(h ^ (c[wide].astype(np.uint64) << np.uint64(1)))
        key[wide] = h | HASHED
    return key, wide


def _decoded(keys: np.ndarray) -> np.ndarray:
    """The grams of keys that are not hashed."""
    mask = np.uint64((1 << NARROW) - 1)
    return np.stack([(keys >> np.uint64(NARROW * (ORDER - 1 - k)) & mask).astype(np.uint32) for k in range(ORDER)], axis=1)


def symbol_stream(texts: list[str]):
    """The symbols of a batch: (stream, places that are predicted, document of
    each place, words that repeat and that do not per document).

    A document is START symbols, then its words with an END each; a word's
    context is the end of the words before it.  A word that repeats is one
    REPEAT, so its places are not predicted; any other one but a document's
    first is marked NEW."""
    none, zeros = np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    codes, docs = codepoints(texts)
    blank = is_ws(codes)
    codes = np.where((codes <= NEW) & ~blank, REPLACED, codes).astype(np.uint32)
    starts, ends, doc = word_spans(blank, docs)
    if not len(starts):
        return np.zeros(0, np.uint32), none, none, zeros, zeros
    words = piece_hashes(codes, starts, ends)
    again = repeats(words, doc)
    inside = np.zeros(len(words), dtype=bool)
    inside[1:] = doc[1:] == doc[:-1]
    n = ends - starts
    lead = np.where(inside, 0, ORDER - 1)
    at = offsets(lead + n + 1)
    stream = np.full(at[-1], START, dtype=np.uint32)
    begin = at[:-1] + lead
    stream[ranges(begin, n)] = codes[ranges(starts, n)]
    stream[at[1:] - 1] = END
    kept = ~again
    places = ranges(begin[kept], n[kept] + 1)
    return stream, places, np.repeat(doc[kept], n[kept] + 1), np.bincount(doc[again], minlength=len(texts)), np.bincount(doc[inside & kept], minlength=len(texts))


def _columns(stream: np.ndarray, places: np.ndarray) -> list[np.ndarray]:
    return [stream[places - (ORDER - 1 - k)] for k in range(ORDER)]


def repeats(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a word equals its predecessor, or ends PHRASE words that its
    document has had before."""
    again = np.zeros(len(words), dtype=bool)
    again[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    m = len(words) - PHRASE + 1
    if m > 0:
        phrase = mix(doc[:m].astype(np.uint64))
        for k in range(PHRASE):
            phrase = mix(phrase ^ words[k: k + m])
        _, first = np.unique(phrase, return_index=True)
        seen = np.ones(m, dtype=bool)
        seen[first] = False
        again[PHRASE - 1:] |= seen & (doc[:m] == doc[PHRASE - 1:])
    return again


def _summed(keys: np.ndarray, counts: np.ndarray | None = None):
    """Distinct keys in order, and the sums of their counts."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(keys))) if counts is None else np.add.reduceat(counts, first) if len(first) else counts
    return keys[first], n.astype(np.int64)


class _Counter:
    """Gram counts of one task or chunk."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = self.merged = 0
        self.wide: dict[int, list] = {}  # hashed key: [gram, count]

    def add(self, texts: list[str]) -> None:
        stream, places, _, repeated, fresh = symbol_stream(texts)
        marks = [(REPEAT_GRAM, int(repeated.sum())), (NEW_GRAM, int(fresh.sum()))]
        for gram, n in marks:
            if n:
                self._keep(gram_keys([np.array([c]) for c in gram])[0], np.array([n]))
        if not len(places):
            return
        columns = _columns(stream, places)
        key, wide = gram_keys(columns)
        if wide.any():
            own, first, n = np.unique(key[wide], return_index=True, return_counts=True)
            grams = np.stack([c[wide][first] for c in columns], axis=1)
            for k, gram, times in zip(own.tolist(), grams, n.tolist()):
                self.wide.setdefault(k, [gram, 0])[1] += times
            key = key[~wide]
        self._keep(*_summed(key))
        if self.held > 2 * self.merged + MERGE_KEYS:
            self._merge()

    def _keep(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.held += len(keys)

    def _merge(self) -> None:
        if self.parts:
            merged = _summed(*(np.concatenate(x) for x in zip(*self.parts)))
            self.parts, self.held, self.merged = [merged], len(merged[0]), len(merged[0])

    def size(self) -> int:
        self._merge()
        return self.held + len(self.wide)

    def flush(self) -> tuple[list[str], np.ndarray]:
        """All grams, as texts, and their counts."""
        self._merge()
        keys, counts = self.parts[0] if self.parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        grams = _decoded(keys) if len(keys) else np.zeros((0, ORDER), np.uint32)
        if self.wide:
            grams = np.concatenate([grams, np.stack([g for g, _ in self.wide.values()])])
            counts = np.concatenate([counts, [n for _, n in self.wide.values()]])
        self.__init__()
        return _as_strings(grams).tolist() if len(grams) else [], counts


def count_grams(texts: DataFrame, limit: int = 500_000) -> DataFrame:
    """(g, c): 5-gram counts of the column ``text``; every task sums its own
    counts first and holds at most about ``limit`` grams and some batches."""

    def count(batches):
        held = _Counter()

        def done():
            strings, counts = held.flush()
            return pa.RecordBatch.from_arrays([pa.array(strings, pa.string()), pa.array(counts, pa.int64())], ["g", "c"])

        for batch in batches:
            for _, _, part in text_batches(batch, "text", BATCH_CHARS):
                held.add(part)
                if held.held > limit and held.size() > limit:
                    yield done()
        if held.size():
            yield done()

    return texts.select("text").mapInArrow(tidy(count), "g string, c long").groupBy("g").agg(F.sum("c").alias("c"))


def _pack(batch: pa.RecordBatch) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return zstandard.ZstdCompressor(level=9).compress(sink.getvalue())


def _unpack(payload: bytes) -> pa.Table:
    raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(payload)).read()
    return pa.ipc.open_stream(raw).read_all()


class _Digest:
    """The id of a chunk: a digest of its texts, so that both passes must
    have seen the same rows in the same order."""

    def __init__(self):
        self.state = hashlib.blake2b(digest_size=8)

    def add(self, texts: list[str]) -> None:
        for t in texts:
            raw = t.encode("utf-8", "surrogatepass")
            self.state.update(len(raw).to_bytes(8, "little") + raw)

    def value(self) -> int:
        return int.from_bytes(self.state.digest(), "little", signed=True)


def _parts(batches):
    """(rows, texts, whether a chunk begins with them): runs of rows of at
    most BATCH_CHARS code points.  Where chunks begin depends on the rows
    alone, not on how Arrow cut them into batches."""
    size = 0
    for batch in batches:
        texts = batch.column("text__").to_pylist()
        start, held, begins = 0, 0, False
        for i, t in enumerate(texts):
            n = len(t)
            new = size > 0 and size + n > CHUNK_CHARS
            if i > start and (new or held + n > BATCH_CHARS):
                yield batch.slice(start, i - start), texts[start:i], begins
                start, held, begins = i, 0, False
            if new:
                size, begins = 0, True
            size, held = size + max(n, 1), held + n
        if len(texts) > start:
            yield batch.slice(start, len(texts) - start), texts[start:], begins


def _asked(batches):
    held, digest, any_rows = _Counter(), _Digest(), False

    def done():
        strings, _ = held.flush()
        return pa.RecordBatch.from_arrays([pa.array([digest.value()] * len(strings), pa.int64()), pa.array(strings, pa.string())], ["chunk", "g"])

    for _, texts, begins in _parts(batches):
        if begins:
            yield done()
            digest = _Digest()
        any_rows = True
        digest.add(texts)
        held.add(texts)
    if any_rows:
        yield done()


def _packed(batches):
    held, digest = [], _Digest()

    def done():
        return pa.RecordBatch.from_arrays([pa.array([digest.value()], pa.int64()), pa.array([held], pa.list_(pa.binary()))], ["chunk", "rows"])

    for rows, texts, begins in _parts(batches):
        if begins:
            yield done()
            held, digest = [], _Digest()
        digest.add(texts)
        held.append(_pack(rows))
    if held:
        yield done()


def score_texts(texts: list[str], keys: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probability and number of symbols of each text; ``keys`` sorted."""

    def look_up(wanted: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
        if not len(keys) or (keys[at] != wanted).any():
            raise RuntimeError("a chunk's grams were not asked for: the input changed between its two scans; pass a stored table")
        return logs[at]

    stream, places, doc, repeated, fresh = symbol_stream(texts)
    total = np.zeros(len(texts))
    for gram, times in ((REPEAT_GRAM, repeated), (NEW_GRAM, fresh)):
        if times.any():
            total += times * look_up(gram_keys([np.array([c]) for c in gram])[0])[0]
    if len(places):
        key, _ = gram_keys(_columns(stream, places))
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        found = np.repeat(look_up(key[first]), np.diff(np.append(first, len(key))))
        total += np.bincount(doc[order], weights=found, minlength=len(texts))
    # whether a word is NEW costs something, but is no symbol of the text
    return total, np.bincount(doc, minlength=len(texts)) + repeated


def answer(g: Column, logp: Column) -> Column:
    """A gram and its log probability as one short text (to 1e-6)."""
    places = F.least(F.round(-logp * 1_000_000), F.lit(10 ** DIGITS - 1)).cast("long").cast("string")
    return F.concat(g, F.lpad(places, DIGITS, "0"))


def _answers(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and log probabilities of answers."""
    if not strings:
        return np.zeros(0, np.uint64), np.zeros(0)
    wide = np.asarray(strings, dtype=f"<U{ORDER + DIGITS}")
    codes = np.frombuffer(wide.tobytes(), dtype=np.uint32).reshape(len(wide), ORDER + DIGITS)
    logs = -1e-6 * (codes[:, ORDER:].astype(np.int64) - 48) @ (10 ** np.arange(DIGITS - 1, -1, -1))
    return gram_keys(list(codes[:, :ORDER].T))[0], logs


def _scored(batches):
    for batch in batches:
        for r in range(batch.num_rows):
            keys, logs = _answers(batch.column("answers")[r].values.to_pylist())
            order = np.argsort(keys)
            keys, logs = keys[order], logs[order]
            for payload in batch.column("rows")[r].values:
                for rows in _unpack(payload.as_py()).to_batches():
                    total, symbols = score_texts(rows.column("text__").to_pylist(), keys, logs)
                    keep = [n for n in rows.schema.names if n != "text__"]
                    yield pa.RecordBatch.from_arrays([*(rows.column(n) for n in keep), pa.array(total), pa.array(symbols, pa.int64())], [*keep, "logp__", "symbols__"])


def _discounts(tables: dict[int, DataFrame]) -> tuple[dict[int, list[float]], int]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more of every
    order, and the number of symbols, in one job."""
    per = [t.agg(F.lit(k).alias("k"), F.count(F.lit(1)).alias("rows"), *[F.sum((F.col("c") == i).cast("long")).alias(f"n{i}") for i in (1, 2, 3, 4)]) for k, t in tables.items()]
    out, symbols = {}, 0
    for row in reduce(DataFrame.unionByName, per).collect():
        n1, n2, n3, n4 = (float(row[f"n{i}"] or 0) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
        parts = ((1, n1, n2), (2, n2, n3), (3, n3, n4))
        out[row.k] = [min(max(i - (i + 1) * y * (b / a), 0.05), i - 0.05) if a and b else 0.75 for i, a, b in parts]
        symbols = row["rows"] if row.k == 1 else symbols
    return out, symbols


def gram_log_probabilities(counts: DataFrame, asked: DataFrame) -> DataFrame:
    """(g, logp) for every gram of ``asked``, by interpolation from order 0.
    Lower orders count the distinct symbols before a gram."""
    tables = {ORDER: counts.select("g", "c")}
    for k in range(ORDER - 1, 0, -1):
        tables[k] = materialize(tables[k + 1].groupBy(F.substring("g", 2, k).alias("g")).agg(F.count(F.lit(1)).alias("c")), f"order{k}")
    wanted = {ORDER: materialize(asked.select("g").distinct(), "wanted")}
    for k in range(ORDER - 1, 0, -1):
        wanted[k] = wanted[ORDER].select(F.substring("g", ORDER - k + 1, k).alias("g")).distinct()
    discounts, symbols = _discounts(tables)
    below = None
    for k in range(1, ORDER + 1):
        d1, d2, d3 = discounts[k]
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        grams = tables[k].select("g", (F.col("c") - cut).alias("top"))
        contexts = tables[k].groupBy(F.substring("g", 1, k - 1).alias("h")).agg(F.sum("c").alias("total"), F.sum(cut).alias("mass"))
        # rows carry the gram only; its context and its end are cut from it where they are joined
        joined = wanted[k].select("g").join(grams, "g", "left").join(contexts, F.substring("g", 1, k - 1) == F.col("h"), "left").drop("h")
        if below is None:
            joined = joined.withColumn("q", F.lit(1.0 / (symbols + 1)))
        else:
            joined = joined.join(below, F.substring("g", 2, k - 1) == F.col("s"), "left").drop("s")
        own = F.coalesce(F.greatest(F.col("top"), F.lit(0.0)), F.lit(0.0)) / F.col("total")
        p = F.when(F.col("total").isNull(), F.col("q")).otherwise(own + F.col("mass") / F.col("total") * F.col("q"))
        below = joined.select(F.col("g").alias("s"), p.alias("q"))
    return materialize(below.select(F.col("s").alias("g"), F.log("q").alias("logp")), "logp")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The distinct ids that ``labels`` marks with quality 1, written, so that
    the planner broadcasts them only if they are small."""
    return materialize(labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct(), "trusted")


def _trusted(rows: DataFrame, trusted: DataFrame, key: str, held_out: bool, folds: int = 5) -> DataFrame:
    """The rows whose ``key`` is in ``trusted`` (distinct ids): those held out
    from the counts, or those counted."""
    ids = trusted.select(F.col(trusted.columns[0]).alias("id__"))
    fold = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(folds)) == 0
    return rows.where(fold if held_out else ~fold).join(ids, F.col(key) == F.col("id__"), "left_semi")


def score(docs: DataFrame, trusted: DataFrame, columns: list[str], text: str = "text", key: str = "doc_id") -> DataFrame:
    """``columns`` of every row with logp__ and symbols__, by a model of the
    trusted rows that are not held out."""
    rows = docs.select(*columns, *[c for c in (key,) if c not in columns], F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text__"))
    counts = materialize(count_grams(_trusted(rows, trusted, key, False).select(F.col("text__").alias("text"))), "grams")
    asked = materialize(rows.select("text__").mapInArrow(tidy(_asked), "chunk long, g string"), "asked")
    answers = asked.join(gram_log_probabilities(counts, asked), "g")
    answers = answers.groupBy("chunk").agg(F.collect_list(answer(F.col("g"), F.col("logp"))).alias("answers"))
    packed = rows.mapInArrow(tidy(_packed), "chunk long, rows array<binary>")
    both = packed.join(answers, "chunk", "left").select("rows", F.coalesce("answers", F.array().cast("array<string>")).alias("answers"))
    schema = T.StructType([f for f in rows.schema.fields if f.name != "text__"] + [T.StructField("logp__", T.DoubleType()), T.StructField("symbols__", T.LongType())])
    return both.mapInArrow(tidy(_scored), schema)


def classify(scored: DataFrame, trusted: DataFrame, lang: str = "lang", key: str = "doc_id", quantile: float = 0.995, margin: float = 1.1,
             shrink: float = 60.0, min_trusted: int = 30) -> DataFrame:
    """Add perplexity, threshold and kept.  ``shrink`` symbols of the mean of
    trusted text are added to every document, so a short one is not judged by
    chance; the threshold is ``margin`` times the ``quantile`` of held-out
    trusted documents of the language."""
    calibration = _trusted(scored.select(key, lang, "logp__", "symbols__"), trusted, key, True)
    spoken = calibration.where("symbols__ > 0")
    mean = lambda: (-F.sum("logp__") / F.sum("symbols__"))
    means = spoken.groupBy(F.col(lang).alias("l__")).agg(mean().alias("mu__"), F.count(F.lit(1)).alias("n__")).where(F.col("n__") >= min_trusted)
    mu_all = spoken.agg(mean()).first()[0] or 0.0

    def based(rows: DataFrame) -> DataFrame:
        rows = rows.join(means, F.col(lang).eqNullSafe(F.col("l__")), "left").drop("l__")
        mu = F.coalesce("mu__", F.lit(mu_all))
        return rows.withColumn("perplexity", F.exp((-F.col("logp__") + shrink * mu) / (F.col("symbols__") + shrink)))

    cal = based(calibration)
    own = cal.where("n__ is not null").groupBy(F.col(lang).alias("l__")).agg(F.percentile_approx("perplexity", quantile, 100_000).alias("t__"))
    every = cal.agg(F.percentile_approx("perplexity", quantile, 100_000)).first()[0]
    out = based(scored).join(own, F.col(lang).eqNullSafe(F.col("l__")), "left")
    limit = F.coalesce("t__", F.lit(every).cast("double")) * margin
    return out.withColumn("threshold", limit).withColumn("kept", F.coalesce(F.col("perplexity") <= limit, F.lit(True))).drop("l__", "mu__", "n__", "t__")


def quality(docs: DataFrame, labels: DataFrame, lang: str = "lang", key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, lang, symbols, perplexity, threshold, kept.
    Trusted text: the documents that ``labels`` marks with quality 1."""
    trusted = trusted_ids(labels)
    scored = materialize(score(docs, trusted, [key, lang], text, key), "scores")
    return classify(scored, trusted, lang, key).select(key, lang, F.col("symbols__").alias("n_symbols"), "perplexity", "threshold", "kept")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with their columns."""
    trusted = trusted_ids(labels)
    rows = docs.select(F.struct("*").alias("row__"), "doc_id", "lang", "text")
    scored = materialize(score(rows, trusted, ["row__", "doc_id", "lang"]), "scored")
    return classify(scored, trusted).where("kept").select("row__.*")
