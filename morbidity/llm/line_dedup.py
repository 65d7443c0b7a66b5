"""Line deduplication by pairwise alignment: blocks of lines that an earlier document has in the same order go from the later one.

A line with words is a hash. Adjacent shared lines make runs: from each line on, and back from it, as few lines as reach the least
number of words of a block, twice it, four times it and so on; all shared lines of a document are one more run, for exact copies. Each run
leads to the first document that holds it (the smallest id), so a run that a third of all documents share makes one pair for each of them,
and no pairs among them. Any block that could be deleted consists of such runs, so some earlier document with each of them is met.
Lines without words stand between no two neighbours, and go with the deleted lines around them.
Documents that meet are aligned on all their shared lines by patience diff: anchors are the lines that are rare in the
strictest sense, once in either document; the longest run of anchors in the same order is kept, grows over equal neighbours, and the gaps
between are aligned in the same way.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from morbidity.llm.common import table
from morbidity.llm.mix import n_words
from morbidity.sources.writers import stage

MIN_WORDS = 10  # of a block that is deleted
PRIME, BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E68B  # of the hashes of runs


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched places (in a, in b), both rising."""
    found: list[tuple[int, int]] = []
    todo = [(0, 0, len(a), len(b))]
    while todo:
        i, j, i_end, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            found.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        place = {x: k for k, x in enumerate(b[j:j_end], j) if in_b[x] == 1}
        anchors = longest([(k, place[x]) for k, x in enumerate(a[i:i_end], i) if in_a[x] == 1 and x in place])
        if anchors:  # each begins a part, in which equal neighbours are matched as its first and last lines
            todo += [(*x, *y) for x, y in zip([(i, j), *anchors], [*anchors, (i_end, j_end)])]
    return sorted(found)


def longest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Most pairs whose second numbers rise; the first do already."""
    ends: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for k, (_, q) in enumerate(pairs):
        at = bisect_left(ends, q)
        ends[at : at + 1] = [q]
        last[at : at + 1] = [k]
        before.append(last[at - 1] if at else -1)
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def deleted(lines: list[dict], min_words: int) -> list[int]:
    """Places in the later document of the blocks to delete; ``lines``: hash, words, places in either document."""
    words = {x["h"]: x["words"] for x in lines}
    a = sorted((p, x["h"]) for x in lines for p in x["own"])
    b = sorted((p, x["h"]) for x in lines for p in x["first"])
    out: list[int] = []
    block: list[tuple[int, int, int]] = []
    for i, j in [*patience([h for _, h in a], [h for _, h in b]), (None, None)]:
        here = None if i is None else (a[i][0], b[j][0], words[a[i][1]])
        if block and (here is None or here[0] != block[-1][0] + 1 or here[1] != block[-1][1] + 1):
            if sum(w for _, _, w in block) >= min_words:
                out += [p for p, _, _ in block]
            block = []
        if here:
            block.append(here)
    return out


def with_wordless(lines: list[dict], gone: list[int]) -> list[int]:
    """From places among the lines with words to places among all lines, with those between two neighbours that both go."""
    at = {n: p for x in lines for n, p in zip(x["own"], x["at"])}
    out = set(gone)
    return [p for n in gone for p in range(at[n], at[n + 1] if n + 1 in out else at[n] + 1)]


def runs(lines: list[tuple[int, int, int]], min_words: int) -> set[int]:
    """Hashes of the runs of a document; ``lines``: place, hash, words, by place."""
    places, hashes, words = zip(*lines)
    rolled = list(accumulate(hashes, lambda x, h: (x * BASE + h) % PRIME, initial=0))
    power = list(accumulate(hashes, lambda x, _: x * BASE % PRIME, initial=1))
    upto = list(accumulate(words, initial=0))
    key = lambda i, j: (rolled[j] - rolled[i] * power[j - i]) % PRIME
    out = {~key(0, len(lines))} if upto[-1] >= min_words else set()  # its lines need not be adjacent: never equal to a run
    cuts = [k for k in range(1, len(lines)) if places[k] != places[k - 1] + 1]
    for begin, end in zip([0, *cuts], [*cuts, len(lines)]):
        least = max(min_words, 1)
        while least <= upto[end] - upto[begin]:
            j = begin
            for i in range(begin, end):
                while j < end and upto[j] - upto[i] < least:
                    j += 1
                if upto[j] - upto[i] < least:
                    break
                out.add(key(i, j))
            i = begin
            for j in range(begin + 1, end + 1):
                if upto[j] - upto[begin] >= least:
                    while upto[j] - upto[i + 1] >= least:
                        i += 1
                    out.add(key(i, j))
            least *= 2
    return out


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(rk, removed): for each later document that loses lines their places, from 0. ``rk`` is the hash of text and id.

    Documents come in order of id, null ids last, then of ``rk``; rows equal in id and text are one document. Null texts have no lines.
    """
    rk = F.xxhash64(text, doc_id)
    order = F.struct(F.col("id").isNull().alias("x"), "id", "rk")
    line = lambda x, i: F.struct(i.alias("pos"), F.xxhash64(x).alias("h"), n_words(x).cast("int").alias("words"))
    worded = F.filter(F.transform(F.split(text, "\n"), line), lambda x: x["words"] > 0)
    # n: place among the lines with words, which are neighbours also across wordless lines
    lines = docs.select(F.col(doc_id).alias("id"), rk.alias("rk"), F.posexplode(worded).alias("n", "x")).select("id", "rk", "n", "x.*")
    lines = stage(lines, "lines")
    # most lines stand in one document; only the others go on
    apart = F.min("rk") != F.max("rk")
    shared = stage(lines.groupBy("h").agg(apart.alias("shared")).where("shared").select("h"), "shared")
    met = stage(lines.join(shared, "h", "left_semi"), "met")
    held = stage(met.groupBy("rk", "h").agg(F.sort_array(F.collect_set(F.struct("n", "pos"))).alias("places"), F.first("words").alias("words")), "held")
    whole = met.groupBy(order.alias("d")).agg(F.sort_array(F.collect_set(F.struct("n", "h", "words"))).alias("lines"))

    def keyed(batches):
        for batch in batches:
            at, sizes, keys = [], [], []
            for k, lines in enumerate(batch.column(1).to_pylist()):
                found = runs([(x["n"], x["h"], x["words"]) for x in lines], min_words)
                at += [k] * len(found)
                sizes += [len(lines)] * len(found)
                keys += found
            columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(sizes, pa.int32()), pa.array(keys, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["d", "n", "key"])

    schema = T.StructType([whole.schema["d"], T.StructField("n", T.IntegerType()), T.StructField("key", T.LongType())])
    found = stage(whole.mapInArrow(keyed, schema), "runs")
    # apart from the table that is joined to them, so that the rows of a hot run can be split
    heads = stage(found.groupBy("key").agg(F.min(F.struct("d", "n")).alias("f"), F.max("d").alias("last")).where("f.d != last"), "heads")
    later = found.join(heads, "key").where("d != f.d")
    met_with = later.select(F.col("d.rk").alias("rk"), F.col("f.d.rk").alias("first"), F.expr("f.n < n").alias("turned")).distinct()
    # the lines of the shorter document are looked up in the longer one
    short, long = F.expr("if(turned, first, rk)").alias("short"), F.expr("if(turned, rk, first)").alias("long")
    from_short = met_with.select("turned", short, long).join(held.withColumnRenamed("rk", "short"), "short")
    both = from_short.join(held.select(F.col("rk").alias("long"), "h", F.col("places").alias("others")), ["long", "h"])
    own = F.expr("if(turned, others, places)")
    pairs = both.groupBy(F.expr("if(turned, long, short)").alias("rk"), F.expr("if(turned, short, long)").alias("first")).agg(
        F.collect_list(
            F.struct("h", "words", own["n"].alias("own"), own["pos"].alias("at"), F.expr("if(turned, places, others)")["n"].alias("first"))
        ).alias("lines")
    )

    def run(batches):
        for batch in batches:
            gone = [with_wordless(lines, deleted(lines, min_words)) for lines in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(gone, pa.list_(pa.int32()))], names=["rk", "gone"])

    gone = pairs.select("rk", "lines").mapInArrow(run, "rk long, gone array<int>").where(F.size("gone") > 0)
    return gone.groupBy("rk").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("removed"))


def dedupe_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All rows of ``docs`` with the text that is left, and ``removed``, the places of deleted lines (such a column is replaced).

    Of exact copies the first stays whole, the others keep at most the wordless lines before and after all others. Null text stays null, an empty text empty; rows
    equal in id and text are treated alike. Lines a document repeats itself are not touched, nor blocks of fewer than ``min_words`` words.
    """
    gone = removals(docs, doc_id, text, min_words).withColumnRenamed("rk", "__gone")
    named = docs.drop("removed").withColumn("__rk", F.xxhash64(text, doc_id))
    joined = named.join(gone, F.col("__rk") == F.col("__gone"), "left")
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    left = F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains("removed", i))
    kept = F.when(F.col("removed").isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    return joined.withColumns({text: kept, "removed": removed}).drop("__rk", "__gone")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, how many are deleted, and the hash of the text that is left."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    lines = F.when(F.col("text").isNotNull(), F.size(F.split("text", "\n"))).otherwise(0).cast("long")
    left = dedupe_lines(docs.withColumn("n_lines", lines))
    return left.select(
        "doc_id",
        "n_lines",
        F.size("removed").cast("long").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )
