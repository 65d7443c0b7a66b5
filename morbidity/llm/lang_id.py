"""Language identification with hyperdimensional profiles.

Each letter class has a random vector of +1 and -1. The n-gram abc is bound as the product of a's vector rotated twice,
b's rotated once and c's; a text is the bundle (sum) of its n-grams, a language the bundle of its labelled texts.
The answer is the language whose profile has the largest cosine with the text.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from morbidity.llm.common import arrow_map, by_batch, table

DIM = 1024
CLASSES = 128  # 0: between words; 1-26: a-z; the rest: all other letters, by code point
SEED = 7
AT_ONCE = 100  # texts whose vectors are made in one matrix product, if they are not long
LETTERS = 250_000  # code points of such texts; a longer text is alone
KINDS = 4096  # n-grams whose vectors are held at once
SLICE = 1e6
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letter_classes() -> np.ndarray:
    """Class of each code point (of lower-cased text)."""
    of = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        if chr(c).isalpha():
            of[c] = c - 96 if 97 <= c <= 122 else 27 + (c * 2654435761 >> 7) % (CLASSES - 27)
    return of


@lru_cache(maxsize=1)
def letter_vectors(dim: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all classes: rotated twice, once, not at all."""
    plain = np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), (CLASSES, dim))
    return np.roll(plain, 2, axis=1), np.roll(plain, 1, axis=1), plain


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, n-gram code) of every three letters in a row, and whether each text has a letter."""
    lowered = [" " + (t or "").lower() for t in texts]
    lengths = np.fromiter(map(len, lowered), np.int64, len(lowered))
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    of = letter_classes()[points].astype(np.int64)
    doc = np.repeat(np.arange(len(lowered)), lengths)
    lettered = np.bincount(doc[of > 0], minlength=len(lowered)) > 0
    keep = of > 0
    keep[1:] |= of[:-1] > 0  # one gap between words
    keep[np.cumsum(lengths) - lengths] = True  # and one before the first
    of, doc = of[keep], doc[keep]
    code = (of[:-2] * CLASSES + of[1:-1]) * CLASSES + of[2:]
    good = (doc[:-2] == doc[2:]) & (code > 0)
    return doc[:-2][good], code[good], lettered


def bundle(codes: np.ndarray, dim: int, seed: int) -> np.ndarray:
    """Vectors of n-grams."""
    first, second, third = letter_vectors(dim, seed)
    bound = first[codes // CLASSES**2] * second[codes // CLASSES % CLASSES] * third[codes % CLASSES]
    return bound.astype(np.float32)


def text_vectors(texts: list[str | None], dim: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """One row for each text, and whether it has a letter. Sums of whole numbers up to 2 ** 24 are exact in any order."""
    doc, code, lettered = ngrams(texts)
    kinds, at = np.unique(code, return_inverse=True)
    order = np.argsort(at, kind="stable")
    doc, at = doc[order], at[order]
    vectors = np.zeros((len(texts), dim), np.float32)
    for low in range(0, len(kinds), KINDS):
        some = kinds[low : low + KINDS]
        a, b = np.searchsorted(at, (low, low + len(some)))
        counts = np.bincount(doc[a:b] * len(some) + at[a:b] - low, minlength=len(texts) * len(some))
        vectors += counts.reshape(len(texts), len(some)).astype(np.float32) @ bundle(some, dim, seed)
    return vectors, lettered


def groups(texts: list[str | None]) -> list[list[str | None]]:
    """Texts in order, so many at a time as a matrix product takes."""
    out, letters = [[]], 0
    for t in texts:
        letters += len(t or "")
        if out[-1] and (len(out[-1]) == AT_ONCE or letters > LETTERS):
            out.append([])
            letters = len(t or "")
        out[-1].append(t)
    return out


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", dim: int = DIM, seed: int = SEED) -> tuple[list[str], np.ndarray]:
    """Languages in order of name, and their profiles, of length 1 and without what they share.

    All rows with text and language are used. A task sends one vector per language, so the driver gets
    ``dim`` numbers for each. Sums of whole numbers are exact, so reruns agree.
    """

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            texts: dict[str, list[str]] = {}
            for t, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts.setdefault(name, []).append(t)
            for name, held in texts.items():
                found = [np.unique(ngrams(some)[1], return_counts=True) for some in groups(held)]
                kinds, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([c for _, c in found]))
                total = sums.setdefault(name, np.zeros(dim))
                for at in range(0, len(kinds), KINDS):  # float64: exact up to 2 ** 53
                    total += counts[at : at + KINDS] @ bundle(kinds[at : at + KINDS], dim, seed).astype(np.float64)
        names = sorted(sums)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([sums[n].tolist() for n in names], pa.list_(pa.float64()))], names=["lang", "sums"])

    labelled = docs.select(F.col(text).alias("t"), F.col(lang).alias("l")).dropna()
    parts = arrow_map(labelled, run, "lang string, sums array<double>")
    cells = parts.select("lang", F.posexplode("sums").alias("i", "v")).groupBy("lang", "i").agg(F.sum("v").alias("v"))
    rows = cells.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("v")).orderBy("lang").collect()
    names = [r.lang for r in rows]
    found = np.array([[x.v for x in r.v] for r in rows]).reshape(len(rows), dim)
    found /= np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)
    return names, found


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text", dim: int = DIM, seed: int = SEED) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names are replaced.

    ``und`` with score 0 for texts that are null or have no letter, and for all texts where nothing was learned. The
    score is the cosine with the best profile, at least 0. Ties go to the first language by name. Each text is
    read whole; nothing is shuffled.
    """
    names, profiles = model
    kept = docs.drop("lang_pred", "score")
    from pyspark.sql import types as T

    out = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    at = kept.columns.index(text)
    profiles = profiles.T.astype(np.float32)

    def start():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(at).to_pylist()
            preds, scores = [], []
            for some in groups(texts) if texts else []:
                vectors, lettered = text_vectors(some, dim, seed)
                if not names:
                    preds += [UNKNOWN] * len(vectors)
                    scores += [0.0] * len(vectors)
                    continue
                cosines = vectors @ profiles / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
                best = cosines.argmax(axis=1)
                preds += [names[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
                scores += [float(min(1.0, max(0.0, c[b]))) if ok else 0.0 for c, b, ok in zip(cosines, best, lettered)]
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(preds, pa.string()), pa.array(scores, pa.float64())], names=out.names)

        return work

    return arrow_map(kept, by_batch(start, SLICE), out)


def held_out(doc_id="doc_id"):
    """A fifth of the documents, which nothing is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", held_out())
    model = learn(docs.where(~F.col("held_out")))
    return identify(docs.select("doc_id", "held_out", "text"), model).drop("text")
