"""Vectorised code-point arrays and piece hashes for batches of texts."""

from __future__ import annotations

import numpy as np

from chanloom.llm.common import offsets, worker_cache

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(_ODD)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def codepoints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in one array, and the texts' offsets."""
    joined = "".join(texts)
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32), offsets([len(t) for t in texts])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    cache = worker_cache()
    have = getattr(cache, "powers", None)
    if have is None or len(have[0]) <= n:
        size = max(1 << 20, 1 << (n + 1).bit_length())
        inverse = pow(_ODD, -1, 1 << 64)
        made = []
        for base in (_ODD, inverse):
            p = np.ones(size, dtype=np.uint64)
            p[1:] = base
            np.multiply.accumulate(p, out=p)
            made.append(p)
        have = cache.powers = (made[0], made[1])
    return have


def piece_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``codes[s:e]`` for each piece: a polynomial over
    scrambled code points, from one cumulative sum over the batch."""
    up, down = _powers(len(codes))
    alphabet, which = np.unique(codes, return_inverse=True) if len(codes) < 4096 else (None, None)
    if alphabet is None:
        top = int(codes.max()) + 1
        mixed = mix(np.arange(top, dtype=np.uint64))[codes]
    else:
        mixed = mix(alphabet.astype(np.uint64))[which]
    total = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(mixed * up[: len(codes)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix(h ^ (ends - starts).astype(np.uint64))


def is_ws(codes: np.ndarray) -> np.ndarray:
    return (codes == 0x20) | ((codes >= 0x09) & (codes <= 0x0D))


def word_spans(blank: np.ndarray, doc_offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document numbers of the maximal runs that are not
    blank; a run never crosses a document's end."""
    n = len(blank)
    if not n:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    edge = np.zeros(n + 1, dtype=bool)
    edge[doc_offsets] = True
    word = ~blank
    before = np.zeros(n, dtype=bool)
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.zeros(n, dtype=bool)
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(doc_offsets, starts, side="right") - 1
