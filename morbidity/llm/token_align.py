"""Alignment of two tokenizers' encodings of the same bytes, by sparse incidence matrices.

An encoding is a matrix with a row for each token and a column for each byte; A · Bᵀ then holds how many bytes two tokens share (overlap
links). With a token's last byte alone, the product holds the pairs that end together; with the groups between common ends as columns, the
pairs in a group. Products are Gustavson's: row by row, each entry of a row of A adds a row of Bᵀ.

Two linked tokens that end together are one a suffix of the other, byte by byte, since both stand in the same text. A token of n bytes has n
suffixes, each of which is one token of the other vocabulary at most (two, for a single byte that is also a piece), so the number of such pairs of
ids has a bound that the vocabularies set, whatever the texts: ``pair_bound``.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from morbidity.llm.common import PART, by_batch, table
from morbidity.sources.writers import stage

PRODUCT_ROWS = 1 << 16  # rows of a product worked out at once
_WIDE = re.compile("[^\x00-\u024f]")
_LETTERS = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


@dataclass(frozen=True)
class Csr:
    """Compressed sparse rows: row i holds columns ``indices[indptr[i] : indptr[i + 1]]``, with ``data``."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.indptr) - 1

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(self.height), np.diff(self.indptr))

    def transposed(self) -> Csr:
        ordered = (self.indices[1:] >= self.indices[:-1]).all()
        order = slice(None) if ordered else np.argsort(self.indices, kind="stable")
        sizes = np.bincount(self.indices, minlength=self.width)
        return Csr(np.concatenate([[0], np.cumsum(sizes)]), self.rows()[order], self.data[order], self.height)


def spans(starts: np.ndarray, ends: np.ndarray, width: int) -> Csr:
    """Token-byte incidence: a row has the columns from its start up to its end."""
    sizes = ends - starts
    indptr = np.concatenate([[0], np.cumsum(sizes)])
    indices = np.arange(indptr[-1]) - np.repeat(indptr[:-1] - starts, sizes)
    return Csr(indptr, indices, np.ones(len(indices), np.int64), width)


def points(columns: np.ndarray, width: int) -> Csr:
    """One column for each row."""
    return Csr(np.arange(len(columns) + 1), columns, np.ones(len(columns), np.int64), width)


def product(a: Csr, b: Csr) -> Csr:
    """a · b, some rows of a at a time: each entry (i, k) of a adds row k of b to row i, then entries of equal place are summed."""
    per_row, indices, data = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    lengths = np.diff(b.indptr)
    for at in range(0, a.height, PRODUCT_ROWS):
        to = min(a.height, at + PRODUCT_ROWS)
        part = slice(a.indptr[at], a.indptr[to])
        k = a.indices[part]
        adds = lengths[k]
        row = np.repeat(np.repeat(np.arange(to - at), np.diff(a.indptr[at : to + 1])), adds)
        from_ = np.arange(adds.sum()) - np.repeat(np.cumsum(adds) - adds - b.indptr[k], adds)
        key = row * max(1, b.width) + b.indices[from_]
        value = np.repeat(a.data[part], adds) * b.data[from_]
        if len(key) and (key[1:] <= key[:-1]).any():  # out of order, or twice
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
            new = np.flatnonzero(np.diff(key, prepend=-1))
            key, value = key[new], np.add.reduceat(value, new)
        per_row.append(np.bincount(key // max(1, b.width), minlength=to - at))
        indices.append(key % max(1, b.width))
        data.append(value)
    return Csr(np.concatenate([[0], np.cumsum(np.concatenate(per_row))]), np.concatenate(indices), np.concatenate(data), b.width)


class ByteLevel:
    """A byte-level BPE vocabulary file of the tokenizers library. Encodes a space and the text.

    Where the file's merges are in the order of their ids, the same vocabulary also makes a tiktoken encoding, which takes a third of
    the time. It encodes texts of Latin letters (up to U+024F), where classes of characters are the same in both libraries; the rest is
    left to the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that are written as themselves; the others follow from 256 on
        hidden = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        size = self.model.get_vocab_size(with_added_tokens=True)
        self.bytes = [b""] * size
        for piece, i in self.model.get_vocab(with_added_tokens=True).items():
            self.bytes[i] = bytes(byte[c] for c in piece) if all(c in byte for c in piece) else piece.encode()
        self.lengths = np.array([len(x) for x in self.bytes], np.int64)
        self.fast = self._ranked(path)

    def _ranked(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids, special = spec["model"]["vocab"], {t["content"] for t in spec["added_tokens"]}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        plain = spec["normalizer"] is None and spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        if not plain or [ids[a + b] for a, b in merges] != list(range(256, 256 + len(merges))):
            return None
        ranks = {self.bytes[i]: i for piece, i in ids.items() if piece not in special}
        return tiktoken.Encoding("from-file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, parts: list[str]) -> list[list[int]]:
        out = [None if self.fast is None or _WIDE.search(p) else self.fast.encode_ordinary(" " + p) for p in parts]
        rest = [k for k, x in enumerate(out) if x is None]
        for k, x in zip(rest, self.model.encode_batch_fast([" " + parts[k] for k in rest], add_special_tokens=False)):
            out[k] = x.ids
        return out


class Pieces:
    """A sentencepiece vocabulary. Encodes the text, before which it sets a space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())
        self.lengths = np.array([len(x) for x in self.bytes], np.int64)

    def encode(self, parts: list[str]) -> list[list[int]]:
        return self.model.encode(parts, num_threads=1)


@lru_cache(maxsize=8)
def vocabulary(path: str):
    """One per Python worker."""
    return ByteLevel(path) if path.endswith(".json") else Pieces(path)


def pair_bound(a: str, b: str) -> int:
    """Most pairs of ids that can ever end together: a token and its suffixes, either way."""
    a, b = vocabulary(a).lengths, vocabulary(b).lengths
    return int(a.sum() + b.sum()) + len(a) + len(b)


def cut(text: str, part: int = PART) -> list[str]:
    """Parts of some ``part`` characters, for memory. A cut takes away a space between two ASCII letters: there both vocabularies begin a
    token with the space, whatever surrounds it, and encoding a part sets its space before it again. Text without such a place stays whole."""
    parts, at = [], 0
    while len(text) - at > part:
        m = _LETTERS.search(text, at + part)
        if m is None:
            break
        parts.append(text[at : m.start()])
        at = m.end()
    return [*parts, text[at:]]


@dataclass(frozen=True)
class Aligned:
    """Ids and byte ends of both encodings of a part, and the group of each token; groups are parted by common ends."""

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    n_groups: int

    @classmethod
    def of(cls, a: list[int], b: list[int], va, vb) -> Aligned:
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        a_ends, b_ends = np.cumsum(va.lengths[a]), np.cumsum(vb.lengths[b])
        ends = np.zeros((2, max([0, *a_ends[-1:], *b_ends[-1:]]) + 1), bool)
        ends[0, a_ends] = ends[1, b_ends] = True
        common = ends.all(axis=0)
        last_a, last_b = common[a_ends], common[b_ends]  # tokens that end their group
        return cls(a, b, a_ends, b_ends, np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b, int(common.sum()))

    @property
    def size(self) -> int:
        return int(self.a_ends[-1]) if len(self.a_ends) else 0

    def links(self, kind: str) -> Csr:
        """Pairs of token places. ``ends``: that end together; ``overlap``: with the number of shared bytes; ``groups``: of the same group."""
        if kind == "overlap":
            a, b = (spans(np.concatenate([[0], e[:-1]]) if len(e) else e, e, self.size) for e in (self.a_ends, self.b_ends))
        elif kind == "ends":
            a, b = points(self.a_ends - 1, self.size), points(self.b_ends - 1, self.size)
        else:
            a, b = points(self.a_group, self.n_groups), points(self.b_group, self.n_groups)
        return product(a, b.transposed())

    def written(self, names) -> bytes:
        """``a1,a2|b1;a3|b2``: ids by group. ``names`` holds each id with each sign that may follow it."""
        na, nb = len(self.a), len(self.b)
        a_at = np.arange(na) + np.searchsorted(self.b_group, self.a_group)  # after the b tokens of earlier groups
        b_at = np.arange(nb) + np.searchsorted(self.a_group, self.b_group, "right")
        code = np.empty(na + nb, np.int64)
        code[a_at] = self.a * 3 + np.append(self.a_group[1:] != self.a_group[:-1], True)
        code[b_at] = names.first_b + self.b * 3 + 2 * np.append(self.b_group[1:] != self.b_group[:-1], True)
        return b"".join(map(names.signed.__getitem__, code.tolist()))


class _Names:
    def __init__(self, n_a: int, n_b: int):
        self.first_b = 3 * n_a
        self.signed = [f"{i}{sign}".encode() for n in (n_a, n_b) for i in range(n) for sign in ",|;"]


@lru_cache(maxsize=2)
def _names(n_a: int, n_b: int) -> _Names:
    return _Names(n_a, n_b)


def align(text: str | None, va, vb, part: int = PART) -> list[Aligned]:
    """The parts of a text aligned; none for a null or empty text, or where an encoding's bytes are not a space and the text."""
    parts = cut(text, part) if text else []
    return _aligned(parts, va.encode(parts), vb.encode(parts), va, vb) if parts else []


def _aligned(parts, a_ids, b_ids, va, vb) -> list[Aligned]:
    out = []
    for p, a, b in zip(parts, a_ids, b_ids):
        want = b" " + p.encode("utf-8", "replace")
        if b"".join(map(va.bytes.__getitem__, a)) != want or b"".join(map(vb.bytes.__getitem__, b)) != want:
            return []
        out.append(Aligned.of(a, b, va, vb))
    return out


def link_rows(docs: DataFrame, a: str, b: str, kind: str = "overlap", text: str = "text", key: str = "doc_id", part: int = PART) -> DataFrame:
    """(``key``, a_at, b_at, a_id, b_id, shared): the links of each text, with the places of their tokens in either encoding. ``kind``: see
    ``Aligned.links``; ``shared`` counts shared bytes for ``overlap`` and is 1 otherwise. Vocabulary files are read on the executors."""

    def start():
        va, vb = vocabulary(a), vocabulary(b)

        def work(batch: pa.RecordBatch):
            for i, t in enumerate(batch.column(1).to_pylist()):
                a_before = b_before = 0
                for x in align(t, va, vb, part):
                    m = x.links(kind)
                    i_at, j_at = m.rows(), m.indices
                    columns = [pa.array(c, pa.int64()) for c in (i_at + a_before, j_at + b_before, x.a[i_at], x.b[j_at], m.data)]
                    whose = batch.column(0).take(pa.array(np.full(len(i_at), i, np.int64)))
                    yield pa.RecordBatch.from_arrays([whose, *columns], names=[key, "a_at", "b_at", "a_id", "b_id", "shared"])
                    a_before, b_before = a_before + len(x.a), b_before + len(x.b)

        return work

    def run(batches):
        work = start()
        for batch in batches:
            yield from work(batch)

    kinds = f"`{key}` {docs.schema[key].dataType.simpleString()}, a_at long, b_at long, a_id long, b_id long, shared long"
    return docs.select(key, text).mapInArrow(run, kinds)


SUMMARY = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, __pairs array<struct<pair: bigint, n: bigint>>"


def align_documents(docs: DataFrame, a: str, b: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), part: int = PART) -> DataFrame:
    """Columns ``keep`` of the rows of ``docs``, with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    Links are those that end together. A pair of ids counts as often as links of any text hold it; a link is best if no other pair of its b id
    counts more; count_sum adds up the links' counts. Texts that are null, empty, or that a tokenizer does not give back byte by byte have
    zeros and ''. Repeated rows count each. Python encodes; sums over the corpus are Spark's. The table of counts is broadcast: it has at most ``pair_bound``
    rows (some 700,000 for vocabularies of 50,000 and 32,000), however large the corpus.
    """
    names = [c.split()[0] for c in SUMMARY.split(", ", 5)]
    kept = docs.select(F.struct(*keep).alias("__kept"), F.col(text).alias("__text"))

    def start():
        va, vb = vocabulary(a), vocabulary(b)
        width, written = len(vb.bytes), _names(len(va.bytes), len(vb.bytes))
        pair = pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())]))

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            cuts = [cut(t, part) if t else [] for t in batch.column(1).to_pylist()]
            flat = [p for c in cuts for p in c]
            a_ids, b_ids = (va.encode(flat), vb.encode(flat)) if flat else ([], [])
            rows, pairs, counts, ends, at = [], [], [], [0], 0
            for c in cuts:
                parts = _aligned(c, a_ids[at : at + len(c)], b_ids[at : at + len(c)], va, vb)
                at += len(c)
                digest, found = hashlib.sha256(), []
                for k, x in enumerate(parts):
                    line = x.written(written)
                    digest.update(line if k + 1 < len(parts) else line[:-1])
                    m = x.links("ends")
                    found.append(x.a[m.rows()] * width + x.b[m.indices])
                ids, n = np.unique(np.concatenate([np.zeros(0, np.int64), *found]), return_counts=True)
                pairs.append(ids)
                counts.append(n)
                ends.append(ends[-1] + len(ids))
                sums = [sum(f(x) for x in parts) for f in (lambda x: len(x.a), lambda x: len(x.b), lambda x: x.n_groups)]
                rows.append((*sums, int(n.sum()), digest.hexdigest() if parts else ""))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, [pa.int64()] * 4 + [pa.string()])]
            values = pa.StructArray.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *x]), pa.int64()) for x in (pairs, counts)], fields=list(pair.value_type))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, type=pair)
            return pa.RecordBatch.from_arrays([batch.column(0), *columns, lists], names=["__kept", *names])

        return work

    kind = kept.schema["__kept"].dataType.simpleString()
    found = kept.mapInArrow(by_batch(start, 4e6), f"__kept {kind}, {SUMMARY}")
    encoded = stage(found.withColumn("__row", F.monotonically_increasing_id()), "encoded")
    width = len(vocabulary(b).bytes)
    links = encoded.select("__row", F.inline("__pairs"))
    total = links.groupBy("pair").agg(F.sum("n").alias("count"))
    total = stage(total.withColumn("b", F.col("pair") % width), "pairs")
    highest = total.groupBy("b").agg(F.max("count").alias("highest"))
    marked = total.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    sums = (
        links.join(F.broadcast(marked), "pair")
        .groupBy("__row")
        .agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))
    )
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_best", "count_sum")]
    return encoded.drop("__pairs").join(sums, "__row", "left").select("__kept.*", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return align_documents(docs, P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
