"""Patience alignment, and line deduplication against a plain version."""

import hashlib
import random
import re

from morbidity.llm.line_dedup import deleted, dedupe_lines, longest, op5_line_dedup, patience

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_longest_rising_run():
    rng = random.Random(1)
    for _ in range(200):
        qs = rng.sample(range(12), rng.randint(0, 9))
        got = longest(list(enumerate(qs)))
        assert all(x < y for x, y in zip([q for _, q in got], [q for _, q in got][1:]))
        best = [1] * len(qs)
        for i in range(len(qs)):
            best[i] += max([best[j] for j in range(i) if qs[j] < qs[i]], default=0)
        assert len(got) == max(best, default=0)


def test_alignments_are_common_subsequences():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.randint(0, 8) for _ in range(rng.randint(0, 14))] for _ in range(2))
        got = patience(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))
    assert patience([1, 2, 3, 4], [9, 2, 3, 8]) == [(1, 1), (2, 2)]
    assert patience([5, 1, 5, 2, 5], [1, 5, 2]) == [(1, 0), (2, 1), (3, 2)]


def test_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    want = brute(rows)  # each document aligned with all earlier ones
    got = op5_line_dedup(spark, SMALL).collect()
    texts = dict(rows)
    assert len(got) == len(rows) and sum(r.n_removed for r in got) > 0
    for r in got:
        gone = want.get(r.doc_id, [])
        left = "\n".join(x for k, x in enumerate((texts[r.doc_id] or "").split("\n")) if k not in set(gone))
        assert r.n_removed == len(gone) and r.text_sha256 == hashlib.sha256(left.encode()).hexdigest()


def test_odd_rows(make):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, f"a b\n{long}\n\nend of one", "z"), (2, f"x\n{long}\ny", "z"), (2, f"x\n{long}\ny", "z"), (3, f"a b\n{long}\n\nend of one", "z"),
        (4, None, "z"), (5, "", "z"), (None, f"{long}\nq", "z"), (6, "a b\nc d\na b", "z"), (7, f"{long}\n{long}", "z"),
    ]
    df = make("doc_id long, text string, removed string", rows)
    out = dedupe_lines(df)
    got = sorted(((r.doc_id, r.text, tuple(r.removed)) for r in out.collect()), key=repr)
    assert got == sorted([
        (1, rows[0][1], ()), (2, "x\ny", (1,)), (2, "x\ny", (1,)), (3, "", (0, 1, 2, 3)), (4, None, ()), (5, "", ()),
        (None, "q", (0,)), (6, "a b\nc d\na b", ()), (7, long, (0,)),
    ], key=repr)
    assert dedupe_lines(df.limit(0)).collect() == []
    assert {r.doc_id: r.text for r in dedupe_lines(df, min_words=2).collect()}[3] == ""


def test_a_line_that_all_share(spark, make):
    line = " ".join(f"w{i}" for i in range(20))
    rows = [(i, f"own {i}\n{line}\nmore {i}") for i in range(500)]
    out = {r.doc_id: list(r.removed) for r in dedupe_lines(make("doc_id long, text string", rows)).collect()}
    assert out == {i: [1] if i else [] for i in range(500)}


def brute(rows, min_words=10):
    """Removed places by id: each document aligned with all earlier ones."""
    docs = sorted((i, t.split("\n")) for i, t in rows if t is not None)
    out = {}
    for k, (i, own) in enumerate(docs):
        gone = set()
        for _, theirs in docs[:k]:
            common = sorted({x for x in own if WORD.search(x)} & set(theirs))
            places = lambda lines, line: [k for k, x in enumerate(lines) if x == line]
            lines = [{"h": x, "words": len(WORD.findall(x)), "own": places(own, x), "first": places(theirs, x)} for x in common]
            gone |= set(deleted(lines, min_words))
        out[i] = sorted(gone)
    return out


def test_partners_by_overlap(make):
    words = lambda tag, n: " ".join(f"{tag}{k}" for k in range(n))
    short, lines = "a short line", [words(f"l{k}x", 4) for k in range(6)]
    rows = [
        (1, f"{short}\n{words('own', 30)}"),
        (2, "\n".join(lines[:2] + [short] + lines[2:])),  # its short line is held by 1
        (3, "\n".join(lines[:2] + [short] + lines[2:])),  # an exact copy
        (4, "\n".join([words("p", 12)] + lines[4:] + [short, words("q", 3)])),  # only 8 words in a row
        (5, "\n".join([words("r", 5)] + lines[1:2] + [short] + lines[2:4])),  # a part of 2
    ]
    got = {r.doc_id: list(r.removed) for r in dedupe_lines(make("doc_id long, text string", rows)).collect()}
    assert got == brute(rows) == {1: [], 2: [], 3: list(range(7)), 4: [], 5: [1, 2, 3, 4]}


def test_against_all_earlier_documents(make):
    """Passages stand once in a document, and in no other order."""
    rng = random.Random(3)
    passages = [[" ".join(f"w{p}x{k}" for _ in range(rng.randint(1, 6))) for k in range(9)] for p in range(6)]
    rows = []
    for i in range(120):
        passage, begin = rng.choice(passages), rng.randint(0, 5)
        cut = passage[begin : begin + rng.randint(2, 9)]
        cut.insert(rng.randint(0, len(cut)), f"own {i}")
        rows.append((i, "\n".join(cut)) if rng.random() < 0.9 or not rows else (i, rng.choice(rows)[1]))
    got = {r.doc_id: list(r.removed) for r in dedupe_lines(make("doc_id long, text string", rows)).collect()}
    want = brute(rows)
    assert got == want and sum(map(len, want.values())) > 100


def test_wordless_lines_inside_blocks(make):
    verses = [f"verse {k} has five words" for k in range(6)]
    poem = "\n\n".join(verses)
    rows = [
        (1, poem), (2, poem), (3, "\n".join(verses)),
        (4, "\n" + "own\n\n" + "\n \t\n\n".join(verses[2:5]) + "\n\nlast"),
        (5, "\n\n".join([verses[0], "between", verses[1]])),
    ]
    got = {r.doc_id: (r.text, list(r.removed)) for r in dedupe_lines(make("doc_id long, text string", rows)).collect()}
    assert got == {
        1: (poem, []), 2: ("", list(range(11))), 3: ("", list(range(6))),
        4: ("\nown\n\n\nlast", list(range(3, 10))), 5: (rows[4][1], []),
    }
