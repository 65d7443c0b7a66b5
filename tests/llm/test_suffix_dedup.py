"""Suffix arrays against sorted suffixes, and removal of earlier strings against a plain version over all windows."""

import collections
import hashlib

import numpy as np
import pytest

from morbidity.llm import suffix_sort
from morbidity.llm.suffix_dedup import SLICE, op13_suffix_dedup, remove_repeats, stretches

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("small, dense", [(1 << 10, 0), (1 << 10, 3), (0, 0)])
def test_suffix_arrays_and_common_prefixes(monkeypatch, small, dense):
    monkeypatch.setattr(suffix_sort, "SMALL", small)
    monkeypatch.setattr(suffix_sort, "DENSE", dense)
    rng = np.random.default_rng(3)
    for trial in range(400):
        text = rng.integers(0, rng.integers(1, 6), rng.integers(0, 70))
        if trial % 4 == 0:
            text = np.tile(text[:6], 9)
        t = text.tolist()
        want = sorted(range(len(t)), key=lambda i: t[i:])
        got = suffix_sort.suffix_array(text)
        assert got.tolist() == want
        shared = [0] * len(t)
        for a, b in zip(want, want[1:]):
            while shared[b] < 5 and max(a, b) + shared[b] < len(t) and t[a + shared[b]] == t[b + shared[b]]:
                shared[b] += 1
        assert suffix_sort.common_prefixes(text, got, 5).tolist() == shared


def test_every_window_is_in_one_stretch_that_holds_its_gram():
    rng = np.random.default_rng(4)
    for size in (99, 100, 101, 5_000, SLICE + 500):
        windows, place = stretches(rng.integers(0, 3, size).astype(np.uint8), 100, 32)
        assert windows.sum() == max(0, size - 99)
        assert ((place >= windows - 1) & (place <= 100 - 32) & (windows > 0)).all()


def plain(rows, length):
    first, out = {}, collections.Counter()
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    data = {k: (rows[k][1] or "").encode() for k in order}
    for k in order:
        for s in range(len(data[k]) - length + 1):
            first.setdefault(data[k][s : s + length], (k, s))
    for k in order:
        gone = bytearray(len(data[k]))
        for s in range(len(data[k]) - length + 1):
            if first[data[k][s : s + length]] != (k, s):
                gone[s : s + length] = b"\1" * length
        kept = bytes(x for x, g in zip(data[k], gone) if not g)
        spans = sum(bytes(gone).split(b"\0")[i] != b"" for i in range(len(bytes(gone).split(b"\0")))) if gone else 0
        out[rows[k][0], len(data[k]), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def got(rows):
    return collections.Counter(
        (r.doc_id, len(r.kept) + sum(s.end - s.start for s in r.removed), sum(s.end - s.start for s in r.removed), len(r.removed), hashlib.sha256(r.kept).hexdigest())
        for r in rows
    )


def words(rng, n):
    return " ".join("abcdefgh"[k] * (1 + k % 3) for k in rng.integers(0, 8, n))


@pytest.mark.parametrize("hot, shard, block", [(2_000, 1 << 20, 1 << 20), (2, 4_000, 700), (0, 4_000, 1)])
def test_odd_rows(make, hot, shard, block):
    rng = np.random.default_rng(9)
    passage, long = words(rng, 60), words(rng, 900)
    texts = [
        None, "", "short", "a" * 99, "a" * 100, "a" * 250, "ab" * 120, passage, passage, f"x {passage} y", f"{passage}{passage}", long, long,
        long[:1000] + "!" + long[1001:], f"{words(rng, 40)} {long[300:700]} {words(rng, 40)}", "漢字かな" * 60, "字かな漢" * 60, long[:137],
        *[f"{words(rng, 12)} {passage} {words(rng, 25)}" for _ in range(12)], *[long[k : k + 400] for k in range(0, 60, 7)],
    ]
    rows = [(int(i), t, "z", 1) for i, t in zip(rng.permutation(len(texts)), texts)] + [(None, passage, "z", 1), (500, long, "z", 1), (500, long, "z", 1)]
    df = make("doc_id long, text string, removed string, __block int", rows)
    out = remove_repeats(df, hot=hot, shard=shard, block=block)
    assert out.columns == ["doc_id", "text", "__block", "kept", "removed"]
    assert got(out.collect()) == plain(rows, 100)


def test_other_lengths(make):
    rng = np.random.default_rng(10)
    rows = [(i, words(rng, int(rng.integers(0, 80)))) for i in range(60)]
    for length, gram in ((20, 7), (9, 9)):
        out = remove_repeats(make("doc_id long, text string", rows), length=length, gram=gram)
        assert got(out.collect()) == plain(rows, length)


def test_empty_table(make):
    assert remove_repeats(make("doc_id long, text string", [])).collect() == []


def test_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    want = plain(rows, 100)
    assert collections.Counter(tuple(r) for r in op13_suffix_dedup(spark, SMALL).collect()) == want
    assert sum(k[2] for k in want) > 1000
