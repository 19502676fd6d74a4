"""Exact token counts of every prefix, by dynamic programming.

For a piece, the last token of each byte prefix is the one token t that ends
there and is compatible with the last token before it (the pair encodes to
itself); its count is one more.  Prefixes of a text that end inside a piece
add that piece's prefix count to the tokens before it; the two places where
the pre-tokenizer looks ahead (runs of white space, contractions) are set
apart.  The stored counts answer truncation and budget questions without
encoding again (``tokens_up_to``, ``longest_prefix``).

Defined cases: a null text is empty and has 0 tokens and no prefixes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanloom.llm.bpe import BATCH_CHARS, LONG, SPACE, PieceTable, Pieces, Vocabulary, char_classes, segments_of, vocabulary
from chanloom.llm.common import offsets, ranges, text_batches, text_of, worker_cache

LIMIT = 1024
#: Token pairs that a worker remembers before it starts anew.
CACHE_PAIRS = 1_000_000


class PrefixCounter:
    """The dynamic program over one vocabulary."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.bytes_of = {i: b for b, i in vocab.ranks.items()}
        self.pairs: dict[int, bool] = {}

    def _fits(self, left: int, right: int) -> bool:
        pair = left << 20 | right
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) > CACHE_PAIRS:
                self.pairs.clear()
            known = self.pairs[pair] = self.vocab.encode(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        return known

    def byte_counts(self, piece: bytes) -> list[int]:
        """Tokens of piece[:1], piece[:2], ... each encoded as one piece."""
        ranks, longest = self.vocab.ranks, self.vocab.longest
        last, count = [-1], [0]
        for end in range(1, len(piece) + 1):
            for begin in range(max(0, end - longest), end):
                token = ranks.get(piece[begin:end])
                if token is not None and (begin == 0 or self._fits(last[begin], token)):
                    last.append(token)
                    count.append(count[begin] + 1)
                    break
        return count[1:]

    def counts(self, piece: str) -> list[int]:
        """Tokens of each prefix of a piece, by code point."""
        raw = piece.encode("utf-8", "surrogatepass")
        at_byte = self.byte_counts(raw)
        if len(raw) == len(piece):
            return at_byte
        ends = np.cumsum([len(c.encode("utf-8", "surrogatepass")) for c in piece])
        return [at_byte[e - 1] for e in ends]


def count_table(path: str) -> PieceTable:
    cache = worker_cache()
    if not hasattr(cache, "count_tables"):
        cache.count_tables = {}
    if path not in cache.count_tables:
        counter = PrefixCounter(vocabulary(path))
        cache.count_tables[path] = PieceTable(counter.counts, np.int32)
    return cache.count_tables[path]


def _segment_counts(segments: list[str], table: PieceTable) -> tuple[np.ndarray, np.ndarray]:
    """Token counts of every non-empty prefix of every segment, and offsets."""
    p = Pieces(segments)
    rows = p.look_up(table)
    if not len(rows):
        return np.zeros(0, np.int32), p.docs
    begin, size = table.begin[rows], table.length[rows]
    within = table.flat[ranges(begin, size)]
    total = table.flat[begin + size - 1]
    running = offsets(total)
    doc = np.searchsorted(p.docs, p.starts, side="right") - 1
    before = running[:-1] - running[p.doc_pieces[doc]]
    out = (within + np.repeat(before, size)).astype(np.int32)
    kind = char_classes()[p.codes]
    # a prefix that ends in white space: the whole run so far is one piece
    tail = p.starts[(kind[p.starts] == SPACE)]
    tail = tail[tail > 0]
    tail = tail[(kind[tail - 1] == SPACE) & ~np.isin(tail, p.docs)]
    if len(tail):
        head = p.starts[np.searchsorted(p.starts, tail) - 1]  # the run's other part is the piece before
        spans = p.look_up(table, head, tail + 1)
        piece = np.searchsorted(p.starts, head)
        out[tail] = before[piece] + table.flat[table.begin[spans] + table.length[spans] - 1]
    # a three-letter contraction cut after two: apostrophe and letter are pieces
    three = np.flatnonzero((size == 3) & (p.codes[p.starts] == 0x27))
    three = three[p.ends[three] - p.starts[three] == 3]
    if len(three):
        s = p.starts[three]
        ok = np.zeros(len(three), bool)
        for a, b in LONG:
            ok |= (p.codes[s + 1] == ord(a)) & (p.codes[s + 2] == ord(b))
        out[s[ok] + 1] = before[three[ok]] + 2
    return out, p.docs


def prefix_counts(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """For each text the tokens of its prefixes of 1, 2, ... code points: one
    array for all texts, and the texts' offsets."""
    table, special = count_table(path), vocabulary(path).special
    segments, firsts, after = segments_of(texts, special)
    if len(segments) == len(texts):
        return _segment_counts(segments, table)
    names = {i: s for s, i in special.items()}
    # a special string counts as text until its last character is there
    longer = [s + (names[a][:-1] if a >= 0 else "") for s, a in zip(segments, after)]
    counts, at = _segment_counts(longer, table)
    parts, sizes = [], []
    for t in range(len(texts)):
        done, rows = 0, []
        for s in range(firsts[t], firsts[t + 1]):
            own = counts[at[s]: at[s + 1]] + done
            rows.append(own)
            n = len(segments[s])
            done = int(own[n - 1]) if n else done
            if after[s] >= 0:
                done += 1
                rows.append(np.array([done], np.int32))
        parts.append(np.concatenate(rows) if rows else np.zeros(0, np.int32))
        sizes.append(len(parts[-1]))
    return np.concatenate(parts).astype(np.int32), offsets(sizes)


def prefix_table(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes and prefix_tokens: element k is the token count of the
    text's first k code points."""

    def run(batches):
        for batch in batches:
            for a, b, part in text_batches(batch, "text", BATCH_CHARS):
                counts, at = prefix_counts(part, tokenizer)
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(counts, pa.int32()))
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("n_bytes"), lists], ["doc_id", "n_bytes", "prefix_tokens"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_of(docs, text).alias("text"))
    return rows.withColumn("n_bytes", F.octet_length("text").cast("long")).mapInArrow(run, "doc_id long, n_bytes long, prefix_tokens array<int>")


def tokens_up_to(prefix_tokens: Column, chars) -> Column:
    """Tokens of the first ``chars`` code points (beyond the end: of all)."""
    k = F.least(F.lit(chars) if isinstance(chars, int) else chars, F.size(prefix_tokens))
    return F.when(k <= 0, F.lit(0)).otherwise(F.get(prefix_tokens, k - 1)).cast("long")


def longest_prefix(prefix_tokens: Column, budget: int) -> Column:
    """Code points of the longest prefix with at most ``budget`` tokens."""
    fits = F.transform(prefix_tokens, lambda n, i: F.when(n <= budget, i + 1).otherwise(0))
    return F.coalesce(F.array_max(fits), F.lit(0))


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""
    stored = prefix_table(docs, tokenizer, key, text)
    n = F.coalesce(F.try_element_at("prefix_tokens", F.lit(-1)), F.lit(0)).cast("long")
    return stored.select("doc_id", "n_bytes", n.alias("n_tokens")).withColumn("over_limit", F.col("n_tokens") > limit)
