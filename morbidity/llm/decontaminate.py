"""Benchmark decontamination with a generalised suffix automaton of the test items' words."""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from morbidity.llm.common import arrow_map, by_batch, table
from morbidity.sources.writers import stage

WINDOW = 13
BLOCK_WORDS = 100_000  # words of items in one automaton; more items are taken in further blocks
FOUND = "n_words long, hits array<struct<start: int, end: int>>, items array<string>"
_PARTED = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # of a text as it is, A-Z included


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case; none for null."""
    return (text or "").encode("utf-8", "replace").lower().translate(_PARTED).split()


class Automaton:
    """All runs of words of all items. State 0 is the empty run; every other has the length of its longest run and a
    link to the state of that run's longest suffix which occurs in other places too."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(item, [self.ids.setdefault(w, len(self.ids)) for w in words]) for item, words in items if words]
        for _, codes in coded:
            last = 0
            for c in codes:
                last = self._extend(last, c)
        #: window -> items that hold it; its length in words; the windows that end where a state's runs end
        self.items: list[set] = []
        self.size: list[int] = []
        own: dict[tuple[int, int], int] = {}
        for item, codes in coded:
            state, k = 0, min(window, len(codes))
            for i, c in enumerate(codes):
                state = self.next[state][c]
                if i + 1 < k:
                    continue
                at = state
                while self.length[self.link[at]] >= k:
                    at = self.link[at]
                if (at, k) not in own:
                    own[at, k] = len(self.items)
                    self.items.append(set())
                    self.size.append(k)
                self.items[own[at, k]].add(item)
        here: dict[int, list[int]] = {}
        for (at, _), w in own.items():
            here.setdefault(at, []).append(w)
        self.ends: list[tuple[int, ...]] = [()] * len(self.next)
        for at in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.ends[at] = (*self.ends[self.link[at]], *here.get(at, ()))

    def _new(self, follow: dict, link: int, length: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The part of q that is reached from p and its suffixes by c."""
        clone = self._new(dict(self.next[q]), self.link[q], self.length[p] + 1)
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new, p = self._new({}, 0, self.length[last] + 1), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """(start, end) of the runs of hit words, in words, and the items with windows among them."""
        state = matched = 0
        follow, link, length, ends, size = self.next, self.link, self.length, self.ends, self.size
        hits, found = [], set()
        for i, c in enumerate(map(self.ids.get, words)):
            if c is None:
                state = matched = 0
                continue
            step = follow[state].get(c)
            if step is None:
                while state and step is None:
                    state = link[state]
                    step = follow[state].get(c)
                if step is None:
                    matched = 0
                    continue
                matched = length[state]
            state = step
            matched += 1
            for w in ends[state]:
                if size[w] <= matched:
                    hits.append((i + 1 - size[w], i + 1))
                    found.add(w)
        return merged(hits), {item for w in found for item in self.items[w]}


def merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(hits):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


@lru_cache(maxsize=2)
def _automaton(digest: str, items: tuple, window: int) -> Automaton:
    """One per Python worker and block of items."""
    return Automaton([(item, words_of(text)) for item, text in items], window)


def item_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", block_words: int = BLOCK_WORDS) -> list[list[tuple]]:
    """The items in blocks of about ``block_words`` words, fetched block by block."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")).where(F.length("text") > 0)
    total = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n = max(1, -(-total // block_words))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return [sorted((r.item or "", r.item is None, r.text) for r in items.where(block == k).select("item", "text").collect()) for k in range(n)]


def find_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (runs of hit words, in words) and ``items``; such columns are replaced.

    A window is ``window`` words in a row of an item, or a whole item of fewer words; a word in any occurrence of a
    window is hit. Null and wordless texts have no words. Items that repeat count by id; an item without id hits
    words but is not listed. Documents are not shuffled. Each block of items is one automaton in each worker;
    if there are several, the documents pass them one by one, and are staged between them.
    """
    kept = docs.drop("n_words", "hits", "items")
    at = kept.columns.index(text)
    out = T.StructType([*kept.schema.fields, *T._parse_datatype_string(FOUND).fields])
    kinds = out["hits"].dataType, out["items"].dataType
    blocks = item_blocks(benchmark, block_words=block_words)
    result = kept.withColumns({"n_words": F.lit(0).cast("long"), "hits": F.array().cast(kinds[0]), "items": F.array().cast(kinds[1])})
    for k, block in enumerate(blocks):
        items = tuple((None if missing else item, words) for item, missing, words in block)
        digest = hashlib.sha256(repr(items).encode()).hexdigest()
        if k:
            result = stage(result, "hits")
        result = arrow_map(result, by_batch(_scanner(digest, items, window, at, out.names)), out)
    return result


def _scanner(digest: str, items: tuple, window: int, at: int, names: list[str]):
    pair = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def start():
        automaton = _automaton(digest, items, window)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            *rest, _, hits, ids = batch.columns
            n, all_hits, all_ids = [], [], []
            for text, old_hits, old_ids in zip(batch.column(at).to_pylist(), hits.to_pylist(), ids.to_pylist()):
                words = words_of(text)
                found, new_ids = automaton.scan(words)
                new_ids.discard(None)
                n.append(len(words))
                both = merged([(h["start"], h["end"]) for h in old_hits] + found) if old_hits else found
                all_hits.append([{"start": a, "end": b} for a, b in both])
                all_ids.append(sorted({*old_ids, *new_ids}))
            made = [pa.array(n, pa.int64()), pa.array(all_hits, pa.list_(pair)), pa.array(all_ids, pa.list_(pa.string()))]
            return pa.RecordBatch.from_arrays([*rest, *made], names=names)

        return work

    return start


def n_hit(hits="hits"):
    return F.aggregate(hits, F.lit(0).cast("long"), lambda n, h: n + h["end"] - h["start"])


def is_contaminated(n_words="n_words", hits="hits", share: int = 20):
    """At least one word in ``share`` is hit."""
    return (n_hit(hits) > 0) & (share * n_hit(hits) >= F.col(n_words))


def remove_hits(found: DataFrame, min_words: int = WINDOW, share: int = 20, text: str = "text") -> DataFrame:
    """The result of ``find_hits`` without contamination: rows over the coverage limit go; of the others, the hit
    runs of ``min_words`` and more are cut out of the text, from the first word's start to the last word's end."""
    kept = found.where(~is_contaminated(share=share))
    names = kept.columns
    at, hit_at = names.index(text), names.index("hits")

    def start():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = []
            for t, hits in zip(batch.column(at).to_pylist(), batch.column(hit_at).to_pylist()):
                long = [h for h in hits if h["end"] - h["start"] >= min_words]
                if long:
                    places = [m.span() for m in _WORD.finditer(t)]
                    for h in reversed(long):
                        t = t[: places[h["start"]][0]] + t[places[h["end"] - 1][1] :]
                texts.append(t)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            return pa.RecordBatch.from_arrays(columns, names=names)

        return work

    return arrow_map(kept, by_batch(start), kept.schema)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = find_hits(docs, table(spark, sf_dir, "benchmark", "item_id", "text")).drop("text")
    ids = F.array_join(F.array_sort("items"), ",")
    return found.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


_SQL_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
OP2_SQL = f"""
with d as (select row_number() over () as rid, doc_id, {_SQL_WORDS} as ws from documents),
i as (select cast(item_id as varchar) as item, ws, least({WINDOW}, len(ws)) as k
  from (select item_id, {_SQL_WORDS} as ws from benchmark) where len(ws) > 0),
iw as (select distinct item, k, array_to_string(ws[p:p+k-1], ' ') as gram
  from (select *, unnest(generate_series(1, len(ws) - k + 1)) as p from i)),
dw as (select rid, k, p, array_to_string(ws[p:p+k-1], ' ') as gram
  from (select rid, ws, k, unnest(generate_series(1, len(ws) - k + 1)) as p from d cross join (select distinct k from iw))),
hit as (select distinct dw.rid, dw.p, dw.k, iw.item from dw join iw on iw.gram = dw.gram and iw.k = dw.k),
places as (select rid, count(distinct q) as n from (select rid, p + unnest(generate_series(0, k - 1)) as q from hit) group by rid),
found as (select rid, count(distinct item) as n, string_agg(distinct item, ',' order by item) as ids
  from hit where item is not null group by rid),
whole as (
  select doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(places.n, 0) as bigint) as n_hit,
    cast(coalesce(found.n, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256
  from d left join places on places.rid = d.rid left join found on found.rid = d.rid)
select *, n_hit > 0 and 20 * n_hit >= n_words as contaminated from whole
"""
