"""Sets of hashed word shingles, made with numpy from the bytes of many texts at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

WORDS = 3
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ODD = 0xD6E8FEB86659FD93  # base of the words' polynomial hash; odd, so that it has an inverse
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Spread 64 bits (the finishing steps of splitmix64)."""
    x = (x + np.uint64(salt)) * np.uint64(1) + _STEP
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers)


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """For each text its sorted distinct shingles of ``words`` words, A-Z taken in lower case.

    A text of fewer words has all of them as one shingle; one without words, or null, has none. Shingles are 64-bit
    hashes.
    """
    coded = [(t or "").encode("utf-8", "replace").lower() + b" " for t in texts]
    ends = np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)))
    data = np.frombuffer(b"".join(coded), np.uint8)
    if not len(data):
        return []
    size = 1 << max(20, int(len(data)).bit_length())
    inked = ~_BLANK[data]
    edges = np.flatnonzero(np.diff(inked, prepend=False))  # each text ends in a blank
    start, end = edges[0::2], edges[1::2]
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_ODD, size)[: len(data)], out=total[1:])
    word = mix((total[end] - total[start]) * _powers(pow(_ODD, -1, 1 << 64), size)[start])
    first = np.searchsorted(start, np.concatenate(([0], ends[:-1])))
    last = np.append(first[1:], len(start))
    joint = word
    for k in range(1, words):
        joint = mix(joint[:-1] * _STEP + word[k:], k) if len(joint) > 1 else joint[:0]
    out = []
    for a, b in zip(first, last):
        if b - a >= words:
            out.append(np.unique(joint[a : b - words + 1]))
        elif b > a:
            whole = word[a : a + 1]
            for k in range(a + 1, b):
                whole = mix(whole * _STEP + word[k : k + 1], 1000 + b - a)
            out.append(mix(whole, 77))
        else:
            out.append(np.empty(0, np.uint64))
    return out
