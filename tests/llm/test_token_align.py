"""Alignment of two tokenizers: sparse products against dense ones, every column against a plain version."""

import collections
import hashlib
from functools import lru_cache

import numpy as np
import public_tokenizers as P
import pytest

from morbidity.llm.token_align import Csr, align, align_documents, cut, link_rows, op11_token_alignment, pair_bound, product, vocabulary

SMALL = "/root/testdata/sf0.001"
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def dense(m: Csr):
    out = np.zeros((m.height, m.width), int)
    np.add.at(out, (m.rows(), m.indices), m.data)
    return out


def test_products_equal_dense_ones():
    rng = np.random.default_rng(1)
    for shape in [(5, 4, 6), (0, 3, 2), (3, 0, 2), (40, 9, 30)]:
        made = []
        for h, w in (shape[:2], shape[1:]):
            full = rng.integers(0, 4, (h, w)) * (rng.random((h, w)) < 0.4)
            r, c = np.nonzero(full)
            made.append(Csr(np.searchsorted(r, np.arange(h + 1)), c, full[r, c], w))
            assert (dense(made[-1].transposed()) == full.T).all()
        got = product(*made)
        assert (dense(got) == dense(made[0]) @ dense(made[1])).all()
        assert all((np.diff(got.indices[a:b]) > 0).all() for a, b in zip(got.indptr, got.indptr[1:]))


@lru_cache
def models():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def encodings(text):
    """[(id, start, end)] of both, in bytes of a space and the text, or None."""
    (a, b), out = models(), []
    byte = {v: k for k, v in plain_bytes().items()}
    for tokens in (
        [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids],
        [(i, bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)],
    ):
        if b"".join(x for _, x in tokens) != (" " + text).encode():
            return None
        at, row = 0, []
        for i, x in tokens:
            row.append((i, at, at + len(x)))
            at += len(x)
        out.append(row)
    return out


def plain_bytes():
    out, n = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + n)
            n += 1
    return out


def plain(rows):
    found, counts = [], collections.Counter()
    for i, text in rows:
        both = encodings(text) if text else None
        if not both:
            found.append((i, 0, 0, 0, [], ""))
            continue
        a, b = both
        ends = {e for _, _, e in b}
        common = [e for _, _, e in a if e in ends]
        groups, start = [], 0
        for e in common:
            groups.append("|".join(",".join(str(t) for t, s, to in side if start <= s and to <= e) for side in (a, b)))
            start = e
        at = collections.defaultdict(list)
        for t, _, e in b:
            at[e].append(t)
        links = [(t, u) for t, _, e in a for u in at[e]]
        counts.update(links)
        found.append((i, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = collections.Counter()
    for (_, u), n in counts.items():
        best[u] = max(best[u], n)
    return collections.Counter(
        (i, n_a, n_b, g, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), sha)
        for i, n_a, n_b, g, links, sha in found
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    (1, None), (2, ""), (3, " "), (4, "a"), (5, "two  blanks and\n\nlines\t"), (6, "▁ is lost"), (7, "ſ ﬁ № 漢字 کتاب 🙂🙂"), (7, "the same id"),
    (8, "the cat <|endoftext|> <s> </s> <0x41>"), (9, "x" * 3000), (10, "the cat sat " * 400), (10, "the cat sat " * 400), (None, "no id"),
    (11, "".join(chr(k) for k in range(32, 700))), (12, " 　\r\n\x0b end "), (13, "don't we'll 'tis"),
]


@pytest.mark.parametrize("part", [65_536, 50])
def test_odd_texts(make, part):
    df = make("doc_id long, text string, n_a string, pair long, __row string", [(*r, "z", 1, None) for r in ODD])
    got = collections.Counter(tuple(r) for r in align_documents(df, A, B, part=part).select(*COLUMNS).collect())
    assert got == plain(ODD)
    assert align_documents(df.limit(0), A, B).collect() == []


def test_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = collections.Counter(tuple(r) for r in op11_token_alignment(spark, SMALL).select(*COLUMNS).collect())
    assert got == plain(rows)
    assert sum(r[3] for r in got) > 1000


def test_both_libraries_encode_latin_texts_alike(documents):
    v = vocabulary(A)
    assert v.fast is not None
    rng = np.random.default_rng(2)
    texts = ["".join(map(chr, rng.choice(0x250, 40))) for _ in range(1500)] + ["".join(map(chr, rng.choice([9, 10, 13, 32, 32, 39, 65, 115, 116, 133, 160, 48], 30))) for _ in range(1500)]
    texts += [chr(a) + chr(b) + "s 's" for a in range(0x250) for b in (32, 65, 160)] + [r.text for r in documents.collect() if r.text] + ["<|endoftext|> x"]
    assert v.encode(texts) == [x.ids for x in v.model.encode_batch([" " + t for t in texts], add_special_tokens=False)]


def test_cuts_do_not_change_an_encoding(documents):
    va, vb = vocabulary(A), vocabulary(B)
    texts = [r.text for r in documents.collect() if r.text and len(r.text) > 200][:40]
    assert any(len(cut(t, 100)) > 2 for t in texts)
    for t in texts:
        whole, parts = align(t, va, vb), align(t, va, vb, 100)
        assert [i for x in parts for i in x.a] == list(whole[0].a) and [i for x in parts for i in x.b] == list(whole[0].b)


def test_overlaps_and_groups(make):
    rows = [(1, "unbelievable tokenisation 漢字"), (2, None)]
    df = make("doc_id long, text string", rows)
    a, b = encodings(rows[0][1])
    overlap = {(1, i, j, x[0], y[0], min(x[2], y[2]) - max(x[1], y[1])) for i, x in enumerate(a) for j, y in enumerate(b) if min(x[2], y[2]) > max(x[1], y[1])}
    assert {tuple(r) for r in link_rows(df, A, B).collect()} == overlap
    ends = {(1, i, j, x[0], y[0], 1) for i, x in enumerate(a) for j, y in enumerate(b) if x[2] == y[2]}
    assert {tuple(r) for r in link_rows(df, A, B, "ends").collect()} == ends
    common = sorted({e for *_, e in a} & {e for *_, e in b})
    group = {(1, i, j, x[0], y[0], 1) for i, x in enumerate(a) for j, y in enumerate(b) if np.searchsorted(common, x[2]) == np.searchsorted(common, y[2])}
    assert {tuple(r) for r in link_rows(df, A, B, "groups").collect()} == group


def test_the_bound_holds():
    ids = collections.defaultdict(lambda: ([], []))
    for side, path in enumerate((A, B)):
        for i, x in enumerate(vocabulary(path).bytes):
            ids[x][side].append(i)
    pairs = set()
    for x, (mine, theirs) in list(ids.items()):
        for k in range(len(x)):
            other = ids.get(x[k:], ([], []))
            pairs |= {(i, j) for i in mine for j in other[1]} | {(i, j) for i in other[0] for j in theirs}
    assert 100_000 < len(pairs) <= pair_bound(A, B) < 800_000
