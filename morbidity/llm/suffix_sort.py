"""Suffix arrays by induced sorting, and permuted common prefixes, over integer arrays.

Suffixes are of type S (smaller than the next one) or L. The leftmost S of each run begins a leftmost-smaller substring; these are sorted by
inducing from their first characters, named by rank, and, unless all names differ, sorted recursively as a text of names. From their
order the L suffixes are induced from left to right and the S suffixes from right to left. Long texts of small alphabets are induced a
bucket at a time in numpy, short texts and names a suffix at a time.
"""

from __future__ import annotations

import numpy as np

SMALL = 1 << 10  # alphabets induced by bucket,
DENSE = 1 << 8  # where a bucket has so many suffixes on average; with fewer, numpy's calls take longer than the suffixes


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of an array of whole numbers from 0, in order; the end of the text is smaller than any of them."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    smaller = suffix_types(text)
    left = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    size = int(text.max()) + 1
    induce = _by_bucket if size <= SMALL and n >= DENSE * size else _by_suffix
    if len(left) > 1:
        order = induce(text, smaller, left)
        marked = np.zeros(n, bool)
        marked[left] = True
        order = order[marked[order]]
        names = _names(text, left, order)
        if names.max() + 1 < len(left):
            left = left[suffix_array(names)]
        else:
            left = order
    return induce(text, smaller, left)


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True for S: the next different character is larger. The last suffix is L."""
    n = len(text)
    step = np.flatnonzero(text[1:] != text[:-1])
    out = np.zeros(n, bool)
    if len(step):
        rises = text[step + 1] > text[step]
        nxt = np.searchsorted(step, np.arange(step[-1] + 1))
        out[: step[-1] + 1] = rises[nxt]
    return out


def _names(text: np.ndarray, left: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Ranks, in the order of the text, of the leftmost-smaller substrings, which ``order`` sorts; each reaches to the first character
    of the next one, the last to the end of the text."""
    ends = np.append(left[1:] + 1, len(text))
    size = np.zeros(len(text), np.int64)
    size[left] = ends - left
    a, b, n = order[:-1], order[1:], size[order]
    same = n[:-1] == n[1:]
    if len(left) > 1:  # the last one ends with the text, as no other does
        same &= (a != left[-1]) & (b != left[-1])
    pairs = np.flatnonzero(same)
    length = n[:-1][pairs]
    at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    unequal = text[np.repeat(a[pairs], length) + at] != text[np.repeat(b[pairs], length) + at]
    differs = np.zeros(len(pairs), bool)
    differs[np.repeat(np.arange(len(pairs)), length)[unequal]] = True
    same[pairs[differs]] = False
    rank = np.zeros(len(text), np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(~same)])
    return rank[left]


def _by_bucket(text: np.ndarray, smaller: np.ndarray, left: np.ndarray) -> np.ndarray:
    n, size = len(text), int(text.max()) + 1
    text = text.astype(np.uint16)
    ends = np.cumsum(np.bincount(text, minlength=size))
    heads = ends - np.bincount(text, minlength=size)
    out = np.full(n, -1, np.int64)

    def deal(found: np.ndarray, fill: np.ndarray, way: int) -> None:
        """Appends each to its character's bucket, at the place ``fill``, which moves on by ``way``."""
        chars = text[found]
        order = np.argsort(chars, kind="stable")
        chars, found = chars[order], found[order]
        counts = np.bincount(chars, minlength=size)
        rank = np.arange(len(found)) - (np.cumsum(counts) - counts)[chars]
        out[fill[chars] + way * rank] = found
        fill += way * counts

    seeds = left[np.argsort(text[left], kind="stable")]  # by bucket, in the order given
    seed_ends = np.cumsum(np.bincount(text[left], minlength=size))
    fill = heads.copy()
    deal(np.array([n - 1]), fill, 1)
    for c in range(size):
        done = heads[c]
        while done < fill[c]:
            before = out[done : fill[c]] - 1
            done = fill[c]
            before = before[before >= 0]
            before = before[~smaller[before]]
            if len(before):
                deal(before, fill, 1)
        before = seeds[(seed_ends[c - 1] if c else 0) : seed_ends[c]] - 1
        if len(before):
            deal(before, fill, 1)  # what precedes a leftmost S is L
    large, fill = fill, ends - 1
    for c in range(size - 1, -1, -1):
        done = ends[c] - 1
        while done > fill[c]:
            before = out[fill[c] + 1 : done + 1][::-1] - 1
            done = fill[c]
            before = before[before >= 0]
            before = before[smaller[before]]
            if len(before):
                deal(before, fill, -1)
        before = out[heads[c] : large[c]][::-1] - 1
        before = before[before >= 0]
        before = before[smaller[before]]
        if len(before):
            deal(before, fill, -1)
    return out


def _by_suffix(text: np.ndarray, smaller: np.ndarray, left: np.ndarray) -> np.ndarray:
    sizes = np.bincount(text)
    ends = np.cumsum(sizes)
    heads = (ends - sizes).tolist()
    tails = (ends - 1).tolist()
    t, s, n = text.tolist(), smaller.tolist(), len(text)
    out = [-1] * n
    for i in left[::-1].tolist():
        out[tails[t[i]]] = i
        tails[t[i]] -= 1
    last = n - 1  # the end of the text comes first of all, and L before it
    out[heads[t[last]]] = last
    heads[t[last]] += 1
    for k in range(n):
        i = out[k] - 1
        if i >= 0 and not s[i]:
            c = t[i]
            out[heads[c]] = i
            heads[c] += 1
    tails = (ends - 1).tolist()
    for k in range(n - 1, -1, -1):
        i = out[k] - 1
        if i >= 0 and s[i]:
            c = t[i]
            out[tails[c]] = i
            tails[c] -= 1
    return np.array(out, np.int64)


def common_prefixes(text: np.ndarray, array: np.ndarray, most: int) -> np.ndarray:
    """For each place of the text, how long its suffix agrees with the one before it in the array, up to ``most``.

    In the order of the text a value is at least the one before less 1, and exactly that where the two suffixes are preceded by the same
    character; only the others are compared, character by character, all at once.
    """
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    prior = np.full(n, -1, np.int64)
    prior[array[1:]] = array[:-1]
    at = np.arange(n)
    follows = (at > 0) & (prior > 0)
    follows[follows] = text[at[follows] - 1] == text[prior[follows] - 1]
    follows[1:] &= prior[1:] == prior[:-1] + 1  # the same neighbour, one on
    own = np.flatnonzero(~follows & (prior >= 0))
    length = np.zeros(n, np.int64)
    live, k = own, 0
    while len(live):
        live = live[np.maximum(live, prior[live]) + k < n]
        live = live[text[live + k] == text[prior[live] + k]]
        length[live] += 1
        k += 1
    first = np.maximum.accumulate(np.where(follows, 0, at))
    return np.minimum(np.maximum(length[first] - (at - first), 0), most)
