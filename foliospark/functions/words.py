"""Words and hashed word shingles, vectorised over a batch of texts."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import xxhash

WORD = re.compile(r"\w+")
_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def words_of(text: str | None) -> list[str]:
    """The longest runs of letters, digits and underscores, in lower case; none for null."""
    return WORD.findall(text.lower()) if text else []


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _C2
    x = (x ^ (x >> np.uint64(27))) * _C3
    return x ^ (x >> np.uint64(31))


class WordHash(dict):
    """word -> 64-bit hash, remembered up to a bound so that a worker's memory stays level."""

    def __init__(self, most: int = 1_000_000):
        self.most = most

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_hashes(
    texts: list[str | None], form: Callable[[str | None], str | None], k: int, cache: WordHash
) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Hashes of all runs of ``k`` consecutive words of each text, repeats included.

    Returns the hashes of all texts in a row, each text's first place in them (with the end as last entry), and a
    128-bit digest of each text's word sequence. A text of fewer than ``k`` words has no run.
    """
    hashed, ends, digests = [], [0], []
    for t in texts:
        h = np.array([cache[w] for w in words_of(form(t))], dtype=np.uint64)
        hashed.append(h)
        ends.append(ends[-1] + len(h))
        digests.append(xxhash.xxh3_128_digest(h.tobytes()))
    ends = np.array(ends)
    flat = np.concatenate(hashed) if hashed else np.zeros(0, np.uint64)
    n = len(flat) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64), digests
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _C1 + flat[j : j + n]
    out = mix64(out)
    sizes = np.maximum(np.diff(ends) - k + 1, 0)
    inside = np.ones(n + k, bool)
    for back in range(1, k):  # runs that would cross from one text into the next
        at = ends[1:] - back
        at = at[at >= np.maximum(ends[:-1], 0)]
        inside[at] = False
    return out[inside[:n]], np.concatenate([[0], np.cumsum(sizes)]), digests
