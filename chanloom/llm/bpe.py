"""Byte-level BPE over batches of texts, from a public tokenizer file.

Texts are cut into pieces (the file's pre-tokenizer) with numpy; every
distinct piece is encoded once per worker and looked up afterwards.  Ids and
counts equal those of ``tokenizers`` with add_special_tokens=False: a special
token's string inside a text is one id, as its default.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np

from chanloom.llm.common import offsets, ranges, worker_cache
from chanloom.llm.strings import codepoints, piece_hashes

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: fixed values: the pre-tokenizer's pattern and its contractions
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SHORT, LONG = "stmd", ("re", "ve", "ll")
#: Distinct pieces that a worker keeps before it starts anew.
CACHE_PIECES = 500_000
BATCH_CHARS = 1_000_000


def char_classes() -> np.ndarray:
    """Class of every code point, from the Unicode properties of the pattern."""
    cache = worker_cache()
    if not hasattr(cache, "classes"):
        import regex

        found = np.zeros(0x110000, np.uint8)
        every = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
            for m in regex.finditer(pattern, every):
                shift = [0x800 if x >= 0xD800 else 0 for x in (m.start(), m.end() - 1)]
                a, b = m.start() + shift[0], m.end() + shift[1]
                found[a:b] = kind
        cache.classes = found
    return cache.classes


def piece_starts(codes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Starts of all pieces; ``docs`` (offsets) are hard ends."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    kind = char_classes()[codes]
    first = np.zeros(n + 1, bool)
    first[docs] = True
    first = first[:n]
    run = np.ones(n, bool)
    run[1:] = kind[1:] != kind[:-1]
    run |= first
    start = run.copy()
    # the last white-space character before a run leaves its own run; a space joins the next piece
    heads = np.flatnonzero(run & (kind != SPACE) & ~first)
    after = heads[kind[heads - 1] == SPACE]
    start[after - 1] = True
    start[after[codes[after - 1] == 0x20]] = False
    # contractions: an apostrophe alone between a piece's end and letters
    marks = np.flatnonzero((codes[:-1] == 0x27) & start[:-1] & run[:-1] & (kind[1:] == LETTER) & ~first[1:]) if n > 1 else np.zeros(0, np.int64)
    if len(marks):
        ends = docs[np.searchsorted(docs, marks, side="right")]
        one = np.isin(codes[marks + 1], [ord(c) for c in SHORT])
        two = np.zeros(len(marks), bool)
        room = marks + 2 < ends
        for a, b in LONG:
            two[room] |= (codes[marks[room] + 1] == ord(a)) & (codes[marks[room] + 2] == ord(b))
        for which, width in ((one, 1), (two & ~one, 2)):
            at = marks[which]
            start[at + 1] = False
            rest, end = at + 1 + width, ends[which]
            inside = rest < end
            rest = rest[inside]
            start[rest[kind[rest] == LETTER]] = True
    return np.flatnonzero(start)


class Vocabulary:
    """Ranks, special tokens and a piece encoder of one tokenizer file."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        names = {chr(b): b for b in printable}
        names |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(printable))}
        vocab = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ranks = {bytes(names[c] for c in token): i for token, i in vocab.items() if token not in special}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        made = [vocab[a + b] for a, b in merges]
        if made != sorted(made):
            raise ValueError("this file's ids do not follow its merges")
        self.special = special
        self.longest = max(map(len, self.ranks))
        self.core = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})._core_bpe

    def encode(self, piece: bytes) -> list[int]:
        return self.core.encode_single_piece(piece)


def vocabulary(path: str) -> Vocabulary:
    cache = worker_cache()
    held = getattr(cache, "vocabularies", None)
    if held is None:
        held = cache.vocabularies = {}
    if path not in held:
        held[path] = Vocabulary(path)
    return held[path]


class PieceTable:
    """Hash -> a run of values (ids or counts) of every piece met so far."""

    def __init__(self, values: Callable[[str], list[int]], dtype):
        self.values, self.dtype = values, dtype
        self._empty()

    def _empty(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.begin, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, self.dtype)

    def rows(self, hashes: np.ndarray, text_of: Callable[[int], str]) -> np.ndarray:
        """Row number of each distinct hash; ``text_of(i)`` is its piece."""
        if len(self.hashes) > CACHE_PIECES:
            self._empty()
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))
        fresh = np.flatnonzero(self.hashes[at] != hashes) if len(self.hashes) else np.arange(len(hashes))
        if len(fresh):
            made = [self.values(text_of(i)) for i in fresh]
            sizes = np.fromiter(map(len, made), np.int64, len(made))
            new = np.fromiter((v for m in made for v in m), self.dtype, int(sizes.sum()))
            keys = np.concatenate([self.hashes, hashes[fresh]])
            order = np.argsort(keys, kind="stable")
            self.hashes = keys[order]
            self.begin = np.concatenate([self.begin, len(self.flat) + offsets(sizes)[:-1]])[order]
            self.length = np.concatenate([self.length, sizes])[order]
            self.flat = np.concatenate([self.flat, new])
            at = np.searchsorted(self.hashes, hashes)
        return at


class Pieces:
    """The pieces of a batch of texts (segments between special tokens)."""

    def __init__(self, segments: list[str]):
        self.joined = "".join(segments)
        self.codes, self.docs = codepoints(segments)
        self.starts = piece_starts(self.codes, self.docs)
        self.ends = np.append(self.starts[1:], len(self.codes))
        self.doc_pieces = np.searchsorted(self.starts, self.docs)

    def look_up(self, table: PieceTable, starts=None, ends=None) -> np.ndarray:
        """Row in ``table`` of every piece (or of the given spans)."""
        starts, ends = (self.starts, self.ends) if starts is None else (starts, ends)
        if not len(starts):
            return np.zeros(0, np.int64)
        distinct, first, which = np.unique(piece_hashes(self.codes, starts, ends), return_index=True, return_inverse=True)
        rows = table.rows(distinct, lambda i: self.joined[starts[first[i]]: ends[first[i]]])
        return rows[which.ravel()]


def segments_of(texts: list[str], special: dict[str, int]) -> tuple[list[str], np.ndarray, list[int]]:
    """Texts cut at special strings: segments, each text's first segment, and
    the special id after each segment (-1: none)."""
    if not any(s in t for s in special for t in texts):
        return texts, np.arange(len(texts) + 1), [-1] * len(texts)
    import regex

    cut = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)))
    segments, firsts, after = [], [], []
    for t in texts:
        firsts.append(len(segments))
        at = 0
        for m in cut.finditer(t):
            segments.append(t[at: m.start()])
            after.append(special[m.group()])
            at = m.end()
        segments.append(t[at:])
        after.append(-1)
    return segments, np.array([*firsts, len(segments)]), after


def id_table(path: str) -> PieceTable:
    cache = worker_cache()
    if not hasattr(cache, "id_tables"):
        cache.id_tables = {}
    if path not in cache.id_tables:
        vocab = vocabulary(path)
        cache.id_tables[path] = PieceTable(lambda piece: vocab.encode(piece.encode("utf-8", "surrogatepass")), np.uint32)
    return cache.id_tables[path]


def encode_texts(texts: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in one array (uint32), and the texts' offsets."""
    table, special = id_table(path), vocabulary(path).special
    segments, firsts, after = segments_of(texts, special)
    pieces = Pieces(segments)
    rows = pieces.look_up(table)
    sizes = table.length[rows]
    ids = table.flat[ranges(table.begin[rows], sizes)]
    at = offsets(sizes)[pieces.doc_pieces]
    if len(segments) > len(texts):
        extra = np.array(after)
        has = extra >= 0
        ids = np.insert(ids, at[1:][has], extra[has].astype(ids.dtype))
        at = at + np.concatenate([[0], np.cumsum(has)])
    return ids, at[firsts]
