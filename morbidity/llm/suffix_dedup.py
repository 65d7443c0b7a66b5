"""Removal of byte strings that occur earlier in the corpus, by suffix arrays over shards.

Every window of ``length`` bytes needs its first occurrence among all documents. Windows are brought together by their least gram (of ``GRAM``
bytes, by a hash; the leftmost of equals): equal windows have it at the same place. Neighbouring windows with the same least gram are
one *stretch* of up to ``length`` + ``length`` - ``GRAM`` bytes, and only stretches move:

1. Grams that occur once in the corpus drop out, with most stretches.
2. Of equal stretches the first one stands for all; the windows of the others all occur earlier.
3. Unequal stretches that share a gram go to a shard by it. A shard's stretches, in the corpus's order, are one text, whose suffix array
   and permuted common prefixes bring equal windows together; the first of a run is the earliest.

A gram shared by more than ``HOT`` unequal stretches is not put in one shard: its stretches' windows, a bounded number each, are grouped by
Spark on a 128-bit hash instead. Texts are packed into blocks of about ``BLOCK`` bytes, which are bucketed, so that each later pass over them
meets what was found without moving them.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from morbidity.llm.common import n_bytes, table
from morbidity.llm.suffix_sort import common_prefixes, suffix_array
from morbidity.sources.writers import bucketed, stage

LENGTH = 100
GRAM = 32
BLOCK = 1 << 20  # bytes of text in a block
SLICE = 1 << 20  # bytes of a text that are looked at at once
BUCKET_GRAMS = 1 << 20  # grams that one task compares
SHARD = 1 << 20  # bytes of a shard
HOT = 2_000  # unequal stretches of a gram
BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_LAST = (1 << 63) - 1  # where a null id stands


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@lru_cache(maxsize=4)
def _ways(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(BASE, n), _powers(pow(BASE, -1, 1 << 64), n)


def gram_hashes(text: np.ndarray, size: int) -> np.ndarray:
    """A mixed polynomial hash of each gram, from prefix sums modulo 2 ** 64."""
    up, down = _ways(max(SLICE, 1 << len(text).bit_length()))
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up[: len(text)], out=sums[1:])
    h = (sums[size:] - sums[:-size]) * down[: len(text) - size + 1]
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(32)
    return h


def least_places(h: np.ndarray, width: int) -> np.ndarray:
    """The place of the leftmost least of each ``width`` neighbours, from those of 2, 4, 8, ... neighbours."""
    place, least, span = np.arange(len(h), dtype=np.int32), h, 1
    while span < width:
        step = min(span, width - span)
        right = least[step:] < least[:-step]
        place = np.where(right, place[step:], place[:-step])
        least = np.where(right, least[step:], least[:-step])
        span += step
    return place


def stretches(text: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """A text's stretches: number of windows, and how far from the first window's start the gram is. A long text is looked at in
    slices, whose edges part stretches."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    step = SLICE - length
    for at in range(0, max(0, len(text) - length + 1), step):
        place = least_places(gram_hashes(text[at : at + step + length - 1], gram), length - gram + 1)
        start = np.flatnonzero(np.diff(place, prepend=-1))
        found.append((np.diff(start, append=len(place)), place[start] - start))
    return tuple(np.concatenate(c) for c in zip(*found))


def word_hashes(text: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes at each place."""
    words = np.zeros((len(places), -(-size // 8) * 8), np.uint8)
    if len(places):
        words[:, :size] = np.lib.stride_tricks.sliding_window_view(text, size)[places]
    h = np.zeros(len(places), np.uint64)
    for w in words.view(np.uint64).T:
        h = (h ^ w) * _MIX
        h ^= h >> np.uint64(29)
    return h


class Block:
    """A block's texts one after another, and its stretches, which are numbered in that order."""

    def __init__(self, row: dict):
        self.sizes = np.array(row["__sizes"], np.int64)
        self.text = np.frombuffer(row["__text"], np.uint8)
        self.ends = np.cumsum(self.sizes)
        per_doc = np.array(row["__stretches"], np.int64)
        self.doc = np.repeat(np.arange(len(per_doc)), per_doc)
        self.windows = np.frombuffer(row["__windows"], np.uint16).astype(np.int64)
        before = np.cumsum(self.windows) - self.windows  # windows in earlier stretches, of earlier documents too
        first = np.minimum(np.cumsum(per_doc) - per_doc, max(0, len(before) - 1))
        self.start = before + (self.ends - self.sizes - before[first])[self.doc] if len(before) else before
        self.place = np.frombuffer(row["__places"], np.uint16).astype(np.int64)  # of the gram, from the stretch's start

    def grams(self, gram: int) -> np.ndarray:
        return word_hashes(self.text, self.start + self.place, gram)


PACKED = ["__sizes", "__stretches", "__windows", "__places", "__text"]


def packed(docs: DataFrame, text: str, doc_id: str, keep: list[str], length: int, gram: int, block: int = BLOCK) -> DataFrame:
    """Blocks: neighbouring documents of a task, up to a block's bytes or one document, with their stretches."""
    order = F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST))
    rows = docs.select(F.struct(*keep).alias("__kept"), order.alias("__id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("__t"))
    kept = rows.schema["__kept"].dataType.simpleString()

    def work(batches):
        for batch in batches:
            texts = batch.column(2)
            sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)).astype(np.int64)
            at = 0
            while at < batch.num_rows:
                to = min(batch.num_rows, at + max(1, int(np.searchsorted(np.cumsum(sizes[at:]), block, "right"))))
                each = texts.slice(at, to - at).to_pylist()
                parts = [stretches(np.frombuffer(t, np.uint8), length, gram) for t in each]
                counts = [len(p[0]) for p in parts]
                windows, places = (np.concatenate([p[k] for p in parts]).astype(np.uint16).tobytes() for k in (0, 1))
                columns = batch.column(0).slice(at, to - at), batch.column(1).slice(at, to - at), pa.array(sizes[at:to]), pa.array(counts, pa.int64())
                lists = [pa.ListArray.from_arrays(pa.array([0, to - at], pa.int32()), c) for c in columns]
                values = [pa.array([x], pa.binary()) for x in (windows, places, b"".join(each))]
                yield pa.RecordBatch.from_arrays([*lists, *values], names=["__kept", "__ids", *PACKED])
                at = to

    schema = f"__kept array<{kept}>, __ids array<bigint>, __sizes array<bigint>, __stretches array<bigint>, __windows binary, __places binary, __text binary"
    return rows.mapInArrow(work, schema).withColumn("__block", F.monotonically_increasing_id())


def _each_block(make, names: list[str], kinds: list):
    """For mapInArrow over blocks: ``make`` gives columns for a row, sent on a block at a time."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(i)[k].as_py() for i, n in enumerate(batch.schema.names) if n != "__kept"}
                columns = make(row)
                if len(columns[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return run


def repeated_grams(blocks: DataFrame, n_buckets: int, length: int, gram: int) -> DataFrame:
    """(``__block``, ``__answers``): which of a block's grams occur elsewhere. Grams go to a bucket by their upper bits and are told apart by the
    lower 32 there (a clash only makes a needless candidate); each block sends each gram once, packed, and gets a bit for it."""

    def ask(row):
        grams = np.unique(Block(row).grams(gram))
        bucket = _bucket(grams, n_buckets)
        order = np.argsort(bucket, kind="stable")
        which, first = np.unique(bucket[order], return_index=True)
        low = (grams[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return which, np.full(len(which), row["__block"]), [x.tobytes() for x in np.split(low, first[1:])]

    def answer(t: pa.Table) -> pa.Table:
        asked = [np.frombuffer(x, np.uint32) for x in t["grams"].to_pylist()]
        _, which, n = np.unique(np.concatenate(asked), return_inverse=True, return_counts=True)
        bits = np.split(n[which] > 1, np.cumsum([len(x) for x in asked])[:-1])
        return pa.table([t["bucket"], t["__block"], pa.array([np.packbits(x).tobytes() for x in bits], pa.binary())], names=["bucket", "__block", "bits"])

    sent = blocks.select("__block", *PACKED).mapInArrow(
        _each_block(ask, ["bucket", "__block", "grams"], [pa.int32(), pa.int64(), pa.binary()]), "bucket int, __block long, grams binary"
    )
    answers = sent.groupBy("bucket").applyInArrow(answer, "bucket int, __block long, bits binary")
    return answers.groupBy("__block").agg(F.collect_list(F.struct("bucket", "bits")).alias("__answers"))


def _bucket(grams: np.ndarray, n: int) -> np.ndarray:
    return ((grams >> np.uint64(32)) % np.uint64(n)).astype(np.int32)


def candidate_stretches(blocks: DataFrame, answers: DataFrame, n_buckets: int, length: int, gram: int) -> DataFrame:
    """(c1, c2, gram, id, ``__block``, at, again): stretches whose gram occurs elsewhere, by number in their block, with a 128-bit hash of
    their bytes. ``again``: an equal one stands before it in the block."""

    def work(row):
        b = Block(row)
        all_grams = b.grams(gram)
        grams, which, n = np.unique(all_grams, return_inverse=True, return_counts=True)
        bucket, repeated = _bucket(grams, n_buckets), n > 1
        order = np.argsort(bucket, kind="stable")
        begin = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
        for a in row["__answers"]:
            mine = order[begin[a["bucket"]] : begin[a["bucket"] + 1]]
            repeated[mine] |= np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=len(mine)).astype(bool)
        at = np.flatnonzero(repeated[which])
        text = row["__text"]
        spans = zip(b.start[at].tolist(), (b.start[at] + b.windows[at] + length - 1).tolist())
        hashes = np.frombuffer(b"".join(xxhash.xxh3_128_digest(text[s:e]) for s, e in spans), np.int64).reshape(-1, 2)
        ids = np.array(row["__ids"], np.int64)[b.doc[at]]
        order = np.lexsort((at, ids, hashes[:, 1], hashes[:, 0]))
        again = np.zeros(len(at), bool)
        again[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]).all(axis=1)
        return hashes[:, 0], hashes[:, 1], all_grams[at].view(np.int64), ids, np.full(len(at), row["__block"]), at, again

    names = ["c1", "c2", "gram", "id", "__block", "at", "again"]
    kinds = [pa.int64()] * 5 + [pa.int32(), pa.bool_()]
    joined = blocks.select("__block", "__ids", *PACKED).join(answers, "__block")
    return joined.mapInArrow(_each_block(work, names, kinds), "c1 long, c2 long, gram long, id long, __block long, at int, again boolean")


def _windows(repeats: DataFrame) -> DataFrame:
    """Repeated windows of stretches, packed by block."""
    return repeats.groupBy("__block").agg(F.collect_list(F.struct("at", "bits")).alias("__gone"))


def _narrowed(parts: list[np.ndarray], length: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Each stretch from its first to its last window whose hash occurs again here, and where that begins. Equal windows have equal hashes, so
    that nothing is lost; most stretches share a gram and no window."""
    text = np.concatenate(parts)
    ends = np.cumsum([len(p) for p in parts])
    begin = ends - [len(p) for p in parts]
    windows = ends - begin - length + 1
    whose = np.repeat(np.arange(len(parts)), windows)
    nth = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    h = gram_hashes(text, length)[begin[whose] + nth]
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    hit, place = whose[twice], nth[twice]
    first, last = np.zeros(len(parts), np.int64), np.full(len(parts), -length)
    np.maximum.at(last, hit, place)
    first[:] = windows
    np.minimum.at(first, hit, place)
    return [p[f : e + length] for p, f, e in zip(parts, first, last)], first


def shard_repeats(shards: DataFrame, length: int) -> DataFrame:
    """(``__block``, at, bits): by shard, which windows of its stretches occur earlier in it. Groups are bounded: a shard's stretches."""

    def work(t: pa.Table) -> pa.Table:
        t = t.sort_by([("id", "ascending"), ("__block", "ascending"), ("at", "ascending")])
        parts, firsts = _narrowed([np.frombuffer(x, np.uint8) for x in t["bytes"].to_pylist()], length)
        used = np.flatnonzero([len(p) > 0 for p in parts])
        if not len(used):
            return _none()
        parts = [parts[k] for k in used]
        sizes = np.array([len(p) for p in parts])
        starts = np.cumsum(sizes + 1) - sizes - 1
        text = np.zeros(int((sizes + 1).sum()), np.int64)
        for s, p in zip(starts, parts):
            text[s : s + len(p)] = p.astype(np.int64) + 1  # 0 parts stretches
        array = suffix_array(text)
        shared = common_prefixes(text, array, length)
        ends = np.repeat(starts + sizes, sizes + 1)  # no window reaches over the end of its stretch
        whole = np.arange(len(text)) + length <= ends
        run = np.cumsum(shared[array] < length)
        least = np.full(run[-1] + 1, len(text))
        np.minimum.at(least, run[whole[array]], array[whole[array]])
        earlier = np.zeros(len(text), bool)
        earlier[array] = least[run] < array
        earlier &= whole
        some, bits = [], []
        for k, s, n in zip(used.tolist(), starts, sizes):
            mine = earlier[s : s + n - length + 1]
            if mine.any():
                some.append(k)
                bits.append(np.packbits(np.concatenate([np.zeros(firsts[k], bool), mine, np.zeros(8 * length, bool)])).tobytes())
        return pa.table([t["__block"].take(some), t["at"].take(some), pa.array(bits, pa.binary())], names=["__block", "at", "bits"]) if some else _none()

    def _none() -> pa.Table:
        return pa.table([pa.array([], pa.int64()), pa.array([], pa.int32()), pa.array([], pa.binary())], names=["__block", "at", "bits"])

    return shards.groupBy("shard").applyInArrow(work, "__block long, at int, bits binary")


def hot_repeats(stretch: DataFrame, length: int, most: int) -> DataFrame:
    """Of stretches of up to ``most`` windows, as ``shard_repeats`` for stretches of grams that very many share: windows are grouped by hash, partly before the shuffle."""

    def windows(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                data = batch.column(3)[k].as_py()
                n = len(data) - length + 1
                both = np.frombuffer(b"".join(xxhash.xxh3_128_digest(data[s : s + length]) for s in range(n)), np.int64).reshape(-1, 2)
                same = [pa.array(np.full(n, batch.column(c)[k].as_py()), t) for c, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.int32()))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(both[:, 0]), pa.array(both[:, 1]), *same, pa.array(np.arange(n), pa.int32())], names=["w1", "w2", "id", "__block", "at", "nth"]
                )

    kinds = "w1 long, w2 long, id long, __block long, at int, nth int"
    found = stage(stretch.select("id", "__block", "at", "bytes").mapInArrow(windows, kinds), "hot-windows")
    first = found.groupBy("w1", "w2").agg(F.min(F.struct("id", "__block", "at")).alias("first"))
    later = found.join(first, ["w1", "w2"]).where(F.struct("id", "__block", "at") != F.col("first"))
    nth = later.groupBy("__block", "at").agg(F.collect_list("nth").alias("nth"))

    def eighth(k: int):
        inside = lambda x: F.when(F.shiftright(x, 3) == k, F.pow(F.lit(2), 7 - x % 8).cast("int")).otherwise(0)
        return F.lpad(F.hex(F.aggregate("nth", F.lit(0), lambda s, x: s + inside(x))), 2, "0")

    bits = F.unhex(F.concat(*[eighth(k) for k in range(-(-most // 8))]))
    return nth.select("__block", "at", bits.alias("bits"))


def repeats(spark: SparkSession, blocks: DataFrame, total: int, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """(``__block``, at, bits): repeated windows by stretch; null bits stand for all of them."""
    expected = 2 * total // (length - gram + 2) + 1
    n_buckets = -(-expected // BUCKET_GRAMS)
    answers = repeated_grams(blocks, n_buckets, length, gram)
    found = stage(candidate_stretches(blocks, answers, n_buckets, length, gram), "stretches")
    by_bytes = found.where(~F.col("again")).drop("again").repartition("c1", "c2")
    first = by_bytes.groupBy("c1", "c2").agg(F.min(F.struct("id", "__block", "at")).alias("first"))
    place = F.struct("id", "__block", "at")
    told = stage(by_bytes.join(first, ["c1", "c2"]).select("gram", "id", "__block", "at", (place == F.col("first")).alias("is_first")), "told")
    all_of = F.lit(None).cast("binary").alias("bits")
    whole = found.where("again").select("__block", "at", all_of).unionByName(told.where("not is_first").select("__block", "at", all_of))
    heads = told.where("is_first").select("gram", "id", "__block", "at")
    shared = stage(heads.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "shared-grams")
    wanted = heads.join(shared, "gram").withColumn("hot", F.col("n") > hot)
    wanted = wanted.groupBy("__block").agg(F.collect_list(F.struct("at", "gram", "id", "hot")).alias("__wanted"))
    n_shards = -(-expected // (shard // (2 * length)))

    def fetch(row):
        b = Block(row)
        at = np.array([w["at"] for w in row["__wanted"]])
        spans = zip(b.start[at].tolist(), (b.start[at] + b.windows[at] + length - 1).tolist())
        w = row["__wanted"]
        text = row["__text"]
        return [x["gram"] for x in w], [x["id"] for x in w], np.full(len(w), row["__block"]), at, [x["hot"] for x in w], [text[s:e] for s, e in spans]

    names, kinds = ["gram", "id", "__block", "at", "hot", "bytes"], [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
    joined = blocks.select("__block", *PACKED).join(wanted, "__block")
    bodies = joined.mapInArrow(_each_block(fetch, names, kinds), "gram long, id long, __block long, at int, hot boolean, bytes binary")
    bodies = stage(bodies, "bodies")
    shards = bodies.where("not hot").withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(n_shards))).drop("gram", "hot")
    return whole.unionByName(shard_repeats(shards, length)).unionByName(hot_repeats(bodies.where("hot"), length, length - gram + 1))


def remove_repeats(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None, length: int = LENGTH, gram: int = GRAM,
    hot: int = HOT, shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """Columns ``keep`` (all, if None) with ``kept`` (the bytes that remain, one after another) and ``removed`` (spans of bytes, end exclusive).

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document of smaller id or before in the same text; ids are
    whole numbers. Strings are judged on the texts as they come. Null ids come last; documents of the same id follow the order
    in which they are read. A null text is empty, and stays with no bytes. Columns named ``kept`` and ``removed`` are replaced.
    """
    spark = docs.sparkSession
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("kept", "removed")]
    total = docs.agg(F.sum(n_bytes(text))).first()[0] or 0
    blocks = bucketed(packed(docs, text, doc_id, kept, length, gram, block), f"blocks_{uuid.uuid4().hex}", ["__block"], total)
    gone = _windows(repeats(spark, blocks, total, length, gram, hot, shard))
    kind = blocks.schema["__kept"].dataType.elementType.simpleString()

    def cut(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(batch.schema.get_field_index(n))[k].as_py() for n in PACKED}
                b = Block(row)
                edge = np.zeros(len(b.text) + 1, np.int32)
                gone = batch.column(batch.schema.get_field_index("__gone"))[k].values
                if gone is not None:
                    at, bits = gone.field("at").to_numpy(), gone.field("bits")
                    whole = np.asarray(bits.is_null())
                    np.add.at(edge, b.start[at[whole]], 1)
                    np.add.at(edge, b.start[at[whole]] + b.windows[at[whole]] - 1 + length, -1)
                    for i, x in zip(at[~whole].tolist(), bits.drop_null().to_pylist()):
                        places = b.start[i] + np.flatnonzero(np.unpackbits(np.frombuffer(x, np.uint8), count=int(b.windows[i])))
                        edge[places] += 1
                        edge[places + length] -= 1
                out = np.cumsum(edge[:-1]) > 0
                left, spans = [], []
                for s, e in zip(b.ends - b.sizes, b.ends):
                    mine = out[s:e]
                    left.append(b.text[s:e][~mine].tobytes())
                    turns = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0)).tolist()
                    spans.append([{"start": x, "end": y} for x, y in zip(turns[::2], turns[1::2])])
                rows = batch.column(batch.schema.get_field_index("__kept"))
                own = rows.flatten().slice(rows.offsets[k].as_py() - rows.offsets[0].as_py(), len(left))
                span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([own, pa.array(left, pa.binary()), pa.array(spans, span)], names=["__kept", "kept", "removed"])

    done = blocks.join(gone, "__block", "left").mapInArrow(cut, f"__kept {kind}, kept binary, removed array<struct<start: bigint, end: bigint>>")
    return done.select("__kept.*", "kept", "removed")


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("n_bytes", n_bytes("text"))
    done = remove_repeats(docs, keep=["doc_id", "n_bytes"])
    return done.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
