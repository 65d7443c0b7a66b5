"""Exact Jaccard join of documents' shingle sets in a metric space, as classes of linked documents.

The number of shingles in which two sets differ is a metric. With J >= t it is at most (1 - t) / t times the smaller size, so:

1. Rings. The empty set is the pivot of a first division: its distance to a set is the set's size. Sets of
   one ring may link to those of the next, and by the triangle inequality to no others; so each set is also
   taken into the ring below (its window).
2. Regions. The shingles are dealt into more subspaces than a ring's largest distance, by their hash. As the distance is
   the sum over the subspaces, linked sets are at distance 0 in at least two of them. In each subspace every
   distinct projection is a pivot, and its region the sets at distance 0 from it. A set whose projection is empty
   in two subspaces also has a region for each such pair, so that the empty projection, which says nothing, is never a region by itself.
3. Cells. Regions that share sets are put together, as a first coarse clustering. A cell with few sets is joined
   in one task. A larger one is divided by pivot documents: each set goes to the cell of the nearest pivot, and to those
   of all pivots that are at most 2 * (1 - t) farther (by the triangle inequality, a linked pair meets in
   the cell of either one's pivot). This goes on in the new cells while it saves work; cells of sets that
   are all about as far from each other are dealt out in blocks, and pairs of blocks are joined.
4. Links are verified on the whole sets. Only a tree of each cell's classes leaves the task.

Unrelated texts are at Jaccard distance 1 from every pivot document, so pivots taken from the corpus divide nothing at
the top; that is why rings and subspaces come first.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from morbidity.llm.common import arrow_map, by_batch, table
from morbidity.llm.components import components
from morbidity.llm.shingles import WORDS, mix, shingle_sets
from morbidity.sources.writers import stage

PERCENT = 90  # links need this share of common shingles
CELL_SETS = 1024  # sets joined in one task, if their shingles are few enough
CELL_SHINGLES = 2_000_000
PIVOTS = 6
FILTER_BITS = 1 << 25
SLICE = 1e6


def rings(percent: int, largest: int) -> list[int]:
    """Lower bounds of the rings' sizes. A set of one ring can only link to sets of this and the next."""
    bounds = [max(1, -(-percent // (100 - percent)))]
    while bounds[-1] <= largest:
        bounds.append(max(bounds[-1] + 1, (bounds[-1] - 1) * 100 // percent + 1))
    return bounds


def set_regions(found: np.ndarray, bounds: list[int], percent: int) -> np.ndarray:
    """Region ids of one set, in its own ring and the one below."""
    out = []
    ring = bisect.bisect_right(bounds, len(found)) - 1
    for r in (ring, ring - 1):
        if r < 0:
            continue
        parts = (bounds[r + 1] - 1) * (100 - percent) // percent + 2  # largest distance of a linked pair, and 2
        at = ((mix(found, 5) >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        order = np.argsort(at, kind="stable")
        at, spread = at[order], mix(found[order], 6)
        first = np.flatnonzero(np.diff(at, prepend=np.uint64(parts)))
        name = at[first] + np.uint64(r << 32)
        out.append(mix(np.add.reduceat(spread, first) ^ mix(name, 8), 9))
        if len(first) < parts - 1:
            empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), at[first])
            i, j = np.triu_indices(len(empty), 1)
            out.append(mix(mix(empty[i] + np.uint64(r << 32), 10) + empty[j], 11))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _fingerprint(s: np.ndarray) -> tuple[int, int]:
    return int(mix(s, 1).sum().astype(np.int64)), int(mix(s, 2).sum().astype(np.int64))


def _hashed(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(key, n, h, h2, regions) for (key, t): size and 128-bit fingerprint of each set, and its regions' ids.

    Of equal sets that a task meets, the first alone has regions.
    """

    def start():
        seen: set = set()
        bounds = rings(percent, 1000)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal bounds
            sizes, names, regions = [], [], []
            for s in shingle_sets(batch.column(1).to_pylist(), words):
                sizes.append(len(s))
                names.append(_fingerprint(s))
                regions.append(None)
                if len(s) >= bounds[0] and names[-1] not in seen:
                    seen.add(names[-1])
                    if len(s) >= bounds[-2]:
                        bounds = rings(percent, 2 * len(s))
                    regions[-1] = set_regions(s, bounds, percent).view(np.int64)
            made = [pa.array(c, pa.int64()) for c in (sizes, *(list(zip(*names)) or [(), ()]))]
            return pa.RecordBatch.from_arrays([batch.column(0), *made, pa.array(regions, pa.list_(pa.int64()))], names=out.names)

        return work

    out = T.StructType([docs.schema["key"], *T._parse_datatype_string("n long, h long, h2 long, regions array<long>").fields])
    return arrow_map(docs, by_batch(start, SLICE), out)


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """(h, h2, n, set) for (key, t)."""

    def start():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = shingle_sets(batch.column(1).to_pylist(), words)
            made = [pa.array(c, pa.int64()) for c in (*(list(zip(*map(_fingerprint, sets))) or [(), ()]), list(map(len, sets)))]
            held = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([*made, held], names=["h", "h2", "n", "set"])

        return work

    return arrow_map(docs, by_batch(start, SLICE), "h long, h2 long, n long, set array<long>")


def _clusters(hashed: DataFrame) -> DataFrame:
    """(h, cell): sets that share regions, directly or through others."""
    members = hashed.where(F.col("regions").isNotNull()).select("h", F.explode("regions").alias("region"))
    pivot = F.min("h").over(Window.partitionBy("region"))
    edges = members.withColumn("pivot", pivot).where("h != pivot").select(F.col("h").alias("a"), F.col("pivot").alias("b"))
    return components(edges).select(F.col("node").alias("h"), F.col("root").alias("cell"))


def _passing(rows: DataFrame, near: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Rows (rk, t) that may be among ``near``, so that few texts are shuffled to find out.

    The filter has one bit for each of ``bits`` hash values of ``rk``, whatever the input's size; where very many are set,
    it lets more rows through, and the join that follows still finds the right ones.
    """
    place = F.pmod(F.xxhash64("rk", F.lit(4)), F.lit(bits)) + 1
    filled = near.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    whole = np.zeros(bits // 8, np.uint8)
    for r in filled.collect():
        part = np.frombuffer(bytes(r.bits), np.uint8)
        whole[(r.bucket - 1) * len(part) : r.bucket * len(part)] = part

    def start():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            p = batch.column(2).to_numpy() - 1
            passes = (whole[p >> 3] >> (p & 7).astype(np.uint8)) & 1
            return batch.filter(pa.array(passes.astype(bool))).select(["rk", "t"])

        return work

    return arrow_map(rows.withColumn("p", place), by_batch(start), rows.schema)


def _distances(pairs: DataFrame) -> DataFrame:
    """Adds the Jaccard distance of ``set`` and ``pivot_set`` and drops the latter."""
    kept = pairs.drop("pivot_set")
    at, pivot_at = pairs.columns.index("set"), pairs.columns.index("pivot_set")
    out = T.StructType([*kept.schema.fields, T.StructField("d", T.DoubleType())])

    def start():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            d = []
            for a, b in zip(batch.column(at), batch.column(pivot_at)):
                a, b = a.values.to_numpy(), b.values.to_numpy()
                common = len(np.intersect1d(a, b, assume_unique=True))
                d.append(1 - common / max(1, len(a) + len(b) - common))
            rest = [c for i, c in enumerate(batch.columns) if i != pivot_at]
            return pa.RecordBatch.from_arrays([*rest, pa.array(d, pa.float64())], names=out.names)

        return work

    return arrow_map(pairs, by_batch(start, SLICE), out)


def _room():
    """How many sets of a cell a task takes at once."""
    return F.greatest(F.lit(8), F.least(F.lit(CELL_SETS), F.floor(F.lit(CELL_SHINGLES) / F.max("n"))))


def _divide(sized: DataFrame, percent: int) -> DataFrame:
    """Cells (cell, h, h2, n, set) of which each fits one task, from cells of any size with their ``sets`` and ``room``."""
    columns = ["cell", "h", "h2", "n", "set"]
    sized = stage(sized, "cells")
    small, big = sized.where("sets <= room").select(columns), sized.where("sets > room")
    while not big.isEmpty():
        order = F.xxhash64("h", "h2", "cell")
        slots = big.groupBy("cell", F.pmod(order, F.lit(PIVOTS)).alias("pivot")).agg(F.min(F.struct(order, "h", "h2")).alias("p"))
        chosen = slots.select("cell", "pivot", "p.h", "p.h2")
        pivots = big.join(chosen, ["cell", "h", "h2"]).select("cell", "pivot", F.col("set").alias("pivot_set"))
        far = stage(_distances(big.join(pivots, "cell")), "distances")
        nearest = far.groupBy("cell", "h", "h2").agg(F.min("d").alias("nearest"))
        window = 2 * (100 - percent) / 100 + 1e-9
        placed = far.join(nearest, ["cell", "h", "h2"]).where(F.col("d") <= F.col("nearest") + window)
        held = placed.groupBy("cell", "pivot").agg(F.count("*").cast("double").alias("m"), F.first("sets").alias("sets"))
        work = held.groupBy("cell").agg(F.sum(F.col("m") * F.col("m")).alias("work"), F.first("sets").alias("sets"))
        worth = stage(work.where("work < 0.6 * sets * sets").select("cell"), "worth")
        small = small.unionByName(_blocks(big.join(worth, "cell", "left_anti")).select(columns))
        divided = placed.join(worth, "cell", "left_semi").withColumn("cell", F.xxhash64("cell", "pivot")).select(columns)
        divided = stage(divided, "divided")
        sized = divided.join(divided.groupBy("cell").agg(F.count("*").alias("sets"), _room().alias("room")), "cell")
        small, big = small.unionByName(sized.where("sets <= room").select(columns)), sized.where("sets > room")
    return small


def _blocks(big: DataFrame) -> DataFrame:
    """Cells of all pairs of blocks of a cell; a block has about half the sets that a task takes."""
    blocks = F.ceil(2 * F.col("sets") / F.col("room")).cast("int")
    own = F.pmod(F.xxhash64("h2", "h"), F.col("blocks")).cast("int")
    dealt = big.withColumn("blocks", blocks).withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.withColumn("cell", F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other"), F.lit(1)))


def linked(sets: list[np.ndarray], percent: int) -> list[int]:
    """For each set the smallest number of a set in its class."""
    from collections import deque

    n = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    common = np.zeros((n, n), np.float32)  # whole numbers up to 2 ** 24 are exact
    values, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.diff(values, prepend=values[:1] + np.uint64(1)) != 0
    number = np.cumsum(new) - 1
    shared = np.bincount(number)[number] > 1
    number, owner = np.unique(number[shared], return_inverse=True)[1], owner[shared]
    width = 1 << 12
    bounds = np.searchsorted(number, np.arange(0, (number[-1] if len(number) else 0) + width + 1, width))
    for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        held = np.zeros((n, width), np.float32)
        held[owner[a:b], number[a:b] - k * width] = 1
        common += held @ held.T
    common = common.astype(np.int64)
    link = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
    root = [-1] * n
    for i in range(n):
        if root[i] < 0:
            root[i], todo = i, deque([i])
            while todo:
                for j in np.flatnonzero(link[todo.popleft()]):
                    if root[j] < 0:
                        root[j] = i
                        todo.append(j)
    return root


def _links(cells: DataFrame, percent: int) -> DataFrame:
    """(a, b): a tree of each class of each cell. A task holds one cell at a time."""
    pair = pa.struct([("h", pa.int64()), ("h2", pa.int64())])

    def run(batches):
        cell, names, sets = None, [], []

        def done():
            root = linked(sets, percent) if len(sets) > 1 else [0]
            ends = [(names[r], names[i]) for i, r in enumerate(root) if r != i]
            columns = [pa.array([{"h": e[k][0], "h2": e[k][1]} for e in ends], pair) for k in (0, 1)]
            return pa.RecordBatch.from_arrays(columns, names=["a", "b"])

        for batch in batches:
            for c, h, h2, s in zip(*[x.to_pylist() for x in batch.columns[:3]], batch.column(3)):
                if c != cell:
                    if names:
                        yield done()
                    cell, names, sets = c, [], []
                names.append((h, h2))
                sets.append(s.values.to_numpy().view(np.uint64))
        if names:
            yield done()

    dealt = cells.select("cell", "h", "h2", "set").repartition("cell").sortWithinPartitions("cell", "h", "h2")
    return arrow_map(dealt, run, "a struct<h:long,h2:long>, b struct<h:long,h2:long>")


def _classes(rows: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """For rows (key, rk, t), where key orders rows and rk names them: (key, rk, n, h, h2) of each, and (h, h2, low) of each set, the
    smallest key of its class."""
    ids = rows.select(F.struct("key", "rk").alias("key"), "t")
    hashed = stage(_hashed(ids, words, percent), "hashed")
    alike = hashed.where("n > 0").groupBy("h", "h2").agg(F.min("key.key").alias("low"), F.min("key.rk").alias("rk"), F.first("n").alias("n"))
    alike = stage(alike, "alike")
    cells = _clusters(hashed)
    near = stage(alike.select("h", "h2", "n", "rk").join(cells, "h"), "near")
    again = _passing(rows.select("rk", "t"), near).join(near.select("rk"), "rk", "left_semi")
    sets = _sets(again.select(F.col("rk").alias("key"), "t"), words).drop("n").dropDuplicates(["h", "h2"])
    sizes = near.groupBy("cell").agg(F.count("*").alias("sets"), _room().alias("room"))
    placed = near.drop("rk").join(sizes, "cell").join(sets, ["h", "h2"])
    classes = components(_links(_divide(placed, percent), percent))
    named = alike.withColumn("node", F.struct("h", "h2")).join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("low").alias("low"))
    return hashed.select("key.key", "key.rk", "n", "h", "h2"), named.drop("low").join(smallest, "root").select("h", "h2", "low")


def jaccard_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row; ``component_id`` is the smallest id reachable by links.

    Two rows link when their sets of ``words``-word shingles have Jaccard similarity of ``percent`` / 100 or more; so rows
    with equal sets are always of one class. A null or wordless text has an empty set, links to nothing and is its own
    class. Rows that repeat stay, each with its class. A null id stays null, and never names a class that has an id.
    """
    rows = docs.select(F.col(doc_id).alias("key"), F.xxhash64(text, doc_id).alias("rk"), F.col(text).alias("t"))
    hashed, lows = _classes(rows, words, percent)
    return hashed.join(lows, ["h", "h2"], "left").select(
        F.col("key").alias(doc_id),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("key")).alias("component_id"),
    )


def jaccard_keepers(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each class, with all its columns: that with the smallest id (null ids last), then the smallest text hash.

    Rows with empty sets are classes of their own and stay. Of rows equal in id and text one stays.
    """
    name = F.xxhash64(text, doc_id)
    order = F.struct(F.col(doc_id).isNull().alias("x"), F.col(doc_id).alias("id"), name.alias("rk"))
    rows = docs.select(order.alias("key"), name.alias("rk"), F.col(text).alias("t"))
    hashed, lows = _classes(rows, words, percent)
    placed = hashed.join(lows, ["h", "h2"], "left")
    # rows to drop, and those that are there more than once; the others need no partner
    drop = (F.col("n") > 0) & (F.col("rk") != F.col("low.rk"))
    marks = placed.groupBy(F.col("rk").alias("__mark")).agg(F.max(drop).alias("__drop"), F.count("*").alias("__times"))
    marks = marks.where("__drop or __times > 1")
    marked = docs.withColumn("__rk", name).join(marks, F.col("__rk") == F.col("__mark"), "left")
    once = marked.where("__mark is null").select(docs.columns)
    return once.union(marked.where("not __drop").dropDuplicates(["__rk"]).select(docs.columns))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents", "doc_id", "text"))


OP3_SQL = rf"""
with recursive d as (
  select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select distinct rid, array_to_string(ws[p:p+{WORDS - 1}], ' ') as gram
  from (select rid, ws, unnest(generate_series(1, greatest(1, len(ws) - {WORDS - 1}))) as p from d where len(ws) > 0)),
sizes as (select rid, count(*) as n from s group by rid),
common as (select a.rid as x, b.rid as y, count(*) as c from s a join s b on a.gram = b.gram and a.rid <> b.rid group by a.rid, b.rid),
links as (select x, y from common join sizes a on a.rid = x join sizes b on b.rid = y where 100 * c >= {PERCENT} * (a.n + b.n - c)),
reach as (select rid, rid as r from d union select reach.rid, links.y from reach join links on links.x = reach.r)
select d.doc_id, cast(coalesce(any_value(sizes.n), 0) as bigint) as n_shingles, min(o.doc_id) as component_id
from d left join sizes on sizes.rid = d.rid join reach on reach.rid = d.rid join d o on o.rid = reach.r
group by d.rid, d.doc_id
"""
