"""Jaccard classes, components and decontamination against brute force."""

import collections
import random
import re

import pytest

from morbidity.llm import jaccard_join
from morbidity.llm.components import components
from morbidity.llm.decontaminate import find_hits, is_contaminated, n_hit, remove_hits
from morbidity.llm.jaccard_join import jaccard_classes, jaccard_keepers
from morbidity.llm.shingles import shingle_sets

from llm_brute import lower

BLANK_FREE = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sets_of(rows):
    out = []
    for _, t in rows:
        w = BLANK_FREE.findall(lower(t))
        out.append(frozenset(tuple(w[a : a + 3]) for a in range(max(1, len(w) - 2))) if w else frozenset())
    return out


def brute_classes(rows):
    """(id, size, smallest id of the class) by comparing all pairs."""
    sets = sets_of(rows)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= 90 * (len(a) + len(sets[j]) - common):
                root[find(i)] = find(j)
    low = {}
    for k, (i, _) in enumerate(rows):
        low[find(k)] = min(low.get(find(k), i), i)
    return sorted((i, len(sets[k]), low[find(k)]) for k, (i, _) in enumerate(rows))


def families(seed):
    rng, rows = random.Random(seed), []
    for _ in range(12):
        words = [str(rng.randint(0, 10**6)) for _ in range(rng.choice([8, 10, 11, 12, 15, 20, 30, 60, 150]))]
        for _ in range(rng.choice([1, 5, 40])):
            v = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 4])):
                kind, at = rng.random(), rng.randrange(len(v))
                if kind < 0.4:
                    v[at] = str(rng.randint(0, 10**6))
                elif kind < 0.7:
                    v.insert(at, f"x{rng.randint(0, 9)}")
                elif len(v) > 2:
                    del v[at]
            rows.append((len(rows) * 7 % 997, " ".join(v)))
    return rows + [(2000, None), (2001, ""), (2002, " \t"), (2003, "a"), (2004, "A"), (2005, "a b"), (2006, "a  B"), (2006, "a  B")]


@pytest.mark.parametrize("seed, cell", [(5, 1024), (6, 16)])
def test_classes(spark, make, monkeypatch, seed, cell):
    """With small cells the pivots, windows and blocks are used as well."""
    monkeypatch.setattr(jaccard_join, "CELL_SETS", cell)
    rows = families(seed)
    got = jaccard_classes(make("doc_id long, text string", rows))
    assert sorted(map(tuple, got.collect())) == brute_classes(rows)


def test_classes_of_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    got = sorted(map(tuple, jaccard_classes(documents).collect()))
    assert got == brute_classes(rows)
    kept = sorted(r.doc_id for r in jaccard_keepers(documents).select("doc_id").collect())
    assert kept == sorted({c for _, _, c in got})


def test_keepers_of_odd_rows(make):
    rows = [(1, "a b c d", "z"), (2, "A b c  d", "z"), (1, "a b c d", "y"), (None, "a b c d", "z"), (3, None, "z"), (4, "", "z"), (4, "", "z"), (None, "q w e", "z")]
    df = make("doc_id long, text string, rk string", rows)
    got = sorted(((r.doc_id, r.text) for r in jaccard_keepers(df).collect()), key=repr)
    assert got == sorted([(1, "a b c d"), (3, None), (4, ""), (None, "q w e")], key=repr)
    assert jaccard_keepers(df.limit(0)).collect() == []


def test_shingles_are_the_definition():
    texts = ["a b", "A\tB", "a  b c", "a b c d", None, " ", "ü B c D", "a b c a b c"]
    got = [len(s) for s in shingle_sets(texts)]
    assert got == [1, 1, 1, 2, 0, 0, 2, 3]
    assert (shingle_sets(texts)[0] == shingle_sets(texts)[1]).all()


def test_components(spark):
    rng = random.Random(3)
    ids = [rng.randint(-(2**62), 2**62) for _ in range(200)]
    edges = [(ids[i], ids[i + 1]) for i in range(60)] + [(ids[70], x) for x in ids[71:120]]
    edges += [(rng.choice(ids[120:]), rng.choice(ids[120:])) for _ in range(60)] + [(ids[0], ids[0])]
    root = {x: x for x in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(a)] = find(b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    groups = collections.defaultdict(set)
    for x, r in got.items():
        groups[r].add(x)
    want = collections.defaultdict(set)
    for a, b in edges:
        if a != b:
            want[find(a)] |= {a, b}
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_hits(docs, items, window=13):
    windows = collections.defaultdict(set)
    for i, t in items:
        w = WORD.findall(lower(t))
        k = min(window, len(w))
        for a in range(len(w) - k + 1) if k else ():
            windows[tuple(w[a : a + k])].add(i)
    out = {}
    for i, t in docs:
        w, hit, ids = WORD.findall(lower(t)), set(), set()
        for k in {len(x) for x in windows}:
            for a in range(len(w) - k + 1):
                if tuple(w[a : a + k]) in windows:
                    hit |= set(range(a, a + k))
                    ids |= windows[tuple(w[a : a + k])]
        out[i] = len(w), len(hit), sorted(str(x) for x in ids if x is not None)
    return out


@pytest.mark.parametrize("block", [10**6, 150])
def test_hits_in_one_block_and_in_several(make, block):
    rng = random.Random(4)
    words = lambda n: " ".join(rng.choice("ab") for _ in range(n))
    items = [(i % 25 if i % 7 else None, words(rng.choice([0, 4, 5, 12, 13, 14, 20, 30]))) for i in range(60)]
    docs = [(i, words(rng.randint(0, 200))) for i in range(120)] + [(500, None), (501, ""), (502, "?!")]
    found = find_hits(make("doc_id long, text string, items string", [(*d, "z") for d in docs]), make("item_id long, text string", items), block_words=block)
    want = brute_hits(docs, items)
    for r in found.withColumn("hit", n_hit()).collect():
        assert (r.n_words, r.hit, list(r["items"])) == want[r.doc_id]


def test_contaminated_rows_go_and_runs_are_cut(make):
    item = " ".join(f"w{i}" for i in range(15))
    docs = [(1, "Start. " + item.upper() + "! end " + "x " * 400), (2, item), (3, "clean text"), (4, "a " * 500 + item[:30])]
    found = find_hits(make("doc_id long, text string", docs), make("item_id long, text string", [(7, item)]))
    marked = {r.doc_id: r.c for r in found.withColumn("c", is_contaminated()).collect()}
    assert marked == {1: False, 2: True, 3: False, 4: False}
    cut = {r.doc_id: r.text for r in remove_hits(found).collect()}
    assert cut == {1: "Start. ! end " + "x " * 400, 3: "clean text", 4: docs[3][1]}
    none = find_hits(make("doc_id long, text string", docs), make("item_id long, text string", []))
    assert none.where("size(hits) > 0").count() == 0 and none.where("n_words = 0").count() == 0
