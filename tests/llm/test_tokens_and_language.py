"""Token counts against the tokenizer's own library, languages against held-out labels."""

import random
import tracemalloc

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from morbidity.llm.lang_id import CLASSES, held_out, identify, learn, letter_classes, text_vectors
from morbidity.llm.token_count import compose, count_tokens, op1_token_counts, state_map, vocabulary
from morbidity.llm.token_fst import SPACE, transducer

SMALL = "/root/testdata/sf0.001"
MODEL = sentencepiece.SentencePieceProcessor(model_file=vocabulary())


def expected(text):
    return len(MODEL.encode(text or ""))


def strings(n):
    rng = random.Random(1)
    pieces = transducer(vocabulary()).pieces.multi
    kinds = (
        lambda: "".join(rng.choice("ab cde  the  ▁\n\t#<s>x0é日本\U0001F600ион 123ing\x00") for _ in range(rng.randint(0, 40))),
        lambda: "".join(rng.choice(pieces) for _ in range(rng.randint(1, 8))).replace(SPACE, " "),
        lambda: " " * rng.randint(0, 70) + "a" * rng.randint(0, 40) + " " * rng.randint(0, 5),
    )
    return [rng.choice(kinds)() for _ in range(n)]


def test_transducer_agrees_with_the_library():
    t = transducer(vocabulary())
    for s in strings(1500):
        assert (t.count(SPACE + s.replace(" ", SPACE)) if s else 0) == expected(s), s


def test_state_maps_compose_in_any_cut():
    t, rng = transducer(vocabulary()), random.Random(2)
    for s in strings(400):
        if not s:
            continue
        text = SPACE + s.replace(" ", SPACE)
        cuts = sorted({0, len(text), *(rng.randint(0, len(text)) for _ in range(rng.randint(0, 6)))})
        parts = [text[a:b] for a, b in zip(cuts, cuts[1:])]
        assert compose(t.count, [state_map(t.count, p) for p in parts]) == expected(s), (s, cuts)


def test_forgetting_states_changes_nothing():
    from morbidity.llm.token_fst import Transducer

    t = Transducer(vocabulary(), max_entries=50)
    for s in strings(300):
        assert (t.count(SPACE + s.replace(" ", SPACE)) if s else 0) == expected(s)


def test_whole_table(spark, documents):
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    got = op1_token_counts(spark, SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.n_tokens == expected(texts[r.doc_id]) and r.n_bytes == len((texts[r.doc_id] or "").encode())
        assert r.over_limit == (r.n_tokens > 4096)


def test_odd_rows(spark, make):
    rows = [(1, None, "z"), (1, None, "z"), (2, "", "z"), (3, "a   b\n\n  c", "z"), (3, "a   b\n\n  c", "z"), (None, "x" * 999, "z")]
    df = make("doc_id long, text string, head string", rows).withColumn("n_tokens", F.lit("old"))
    for part in (1, 7, 65_536):
        got = count_tokens(df, vocabulary(), part=part).collect()
        assert sorted((r.n_tokens for r in got)) == sorted(expected(t) for _, t, _ in rows)
        assert got[0].head == "z"
    assert count_tokens(df.limit(0), vocabulary()).collect() == []


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held", held_out())
    model = learn(docs.where("not held"))
    rows = identify(docs.where("held and text is not null and lang is not null and length(text) > 20"), model).collect()
    assert len(rows) > 100 and sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark, make):
    known = make("text string, lang string", [("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "en"), ("x y", None)])
    model = learn(known)
    assert model[0] == ["de", "en"]
    rows = [(1, None, "a"), (2, "", "a"), (3, "12 -- 7", "a"), (4, "the dog", "a"), (4, "the dog", "a"), (5, "und die", "a"), (6, "the " * 30_000, "a")]
    df = make("doc_id long, text string, lang_pred string", rows)
    got = {(r.doc_id, r.lang_pred) for r in identify(df, model).collect()}
    assert got == {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "de"), (6, "en")}
    assert identify(df.limit(0), model).collect() == []
    nothing = learn(known.limit(0))
    assert {r.lang_pred for r in identify(df, nothing).collect()} == {"und"}


def test_memory_of_a_long_text_of_a_large_alphabet():
    random = np.random.default_rng(1)
    long = "".join(map(chr, random.integers(0x4E00, 0x9FA5, 500_000)))
    tracemalloc.start()
    vectors, lettered = text_vectors(["the dog", long, None], 1024, 7)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6 and lettered.tolist() == [True, True, False]
    assert (vectors[0] == text_vectors(["the dog"], 1024, 7)[0][0]).all() and not vectors[2].any()


def plain_vector(text, dim=64, seed=7):
    """The bundle of one text, letter by letter."""
    classes, plain = letter_classes(), np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), (CLASSES, dim)).astype(int)
    shown = [0]
    for c in text.lower():
        k = int(classes[ord(c)])
        if k or shown[-1]:
            shown.append(k)
    total = np.zeros(dim, int)
    for a, b, c in zip(shown, shown[1:], shown[2:]):
        if a or b or c:
            total += np.roll(plain[a], 2) * np.roll(plain[b], 1) * plain[c]
    return total


def test_vectors_and_answers_against_a_plain_version(make):
    texts = ["the cat, and THE dog 12", "der Hund\n\n und die Katze!", "a", "", "é è ж 中文字 x", "... --", "la casa  y el perro " * 40]
    for t, v in zip(texts, text_vectors(texts, 64, 7)[0]):
        assert (v == plain_vector(t)).all()
    known = [(t, "xyz"[i % 3]) for i, t in enumerate(texts)]
    names, profiles = learn(make("text string, lang string", known), dim=64)
    for name, p in zip(names, profiles):
        total = sum(plain_vector(t) for t, x in known if x == name)
        assert np.allclose(p, total / max(np.linalg.norm(total), 1e-12))  # a language without a gram has none
    for r in identify(make("text string", [(t,) for t in texts]), (names, profiles), dim=64).collect():
        v = plain_vector(r.text)
        cosines = profiles @ v / max(np.linalg.norm(v), 1e-12)
        if any(c.isalpha() for c in r.text):
            assert r.score == pytest.approx(max(0, cosines.max()), abs=1e-5) and cosines[names.index(r.lang_pred)] == pytest.approx(cosines.max(), abs=1e-5)
        else:
            assert (r.lang_pred, r.score) == ("und", 0.0)
