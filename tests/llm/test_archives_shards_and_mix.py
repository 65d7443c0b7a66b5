"""WARC round trips with traps, shards and the source mix."""

import collections
import glob
import hashlib
import os
import uuid
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from morbidity.llm import warc
from morbidity.llm.common import prefix_sums, ranked
from morbidity.llm.mix import OP7_SQL, mix_documents, mix_rows, op7_source_mix, targets
from morbidity.llm.shard import op6_sharding, shard_documents, splitters
from morbidity.llm.warc import OP4_SQL, op4_warc
from morbidity.sources.writers import shared_folder

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def bag(rows):
    return collections.Counter(map(tuple, rows))


def test_archives_match_sql(spark, con):
    assert bag(op4_warc(spark, SMALL).collect()) == bag(con.execute(OP4_SQL).fetchall())


TRAP = "x\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\nmore " * 5
PAGES = [
    (1, "u", None), (2, None, ""), (3, "u\r\nWARC/1.0\r\n", "a" * 200), (4, "u", "a" * 200), (5, "u", "a" * 99), (6, "u", "a" * 99),
    (4, "u", "a" * 200), (3, "u", "a" * 200), (7, "u", TRAP), (8, "u", TRAP), (9, "u", "WARC/1.0\r\nContent-Length: 3\r\n\r\nabc"),
    (None, "u", "a" * 200), (10, "u", "ü" * 50), (11, "é", "ü" * 50), *[(100 + i, "u", TRAP + str(i) * i) for i in range(90)],
]


@pytest.mark.parametrize("range_bytes", [warc.RANGE, 500])
def test_records_inside_payloads_are_not_records(spark, make, range_bytes):
    folder = f"{shared_folder(spark)}/t-{uuid.uuid4().hex}"
    warc.write_archives(make("page_id long, url string, html string, __digest string", [(*p, "z") for p in PAGES]), folder, file_records=20)
    found = warc.candidates(spark, folder, range_bytes).persist()
    got = [(r.id, r.kind, r.refers, r.bytes, r.digest) for r in warc.verified(found).collect()]
    first, want = {}, []
    for i, _, h in PAGES:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    for i, _, h in PAGES:
        data, origin = (h or "").encode(), first.get(h or "")
        again = len(data) >= 100 and origin != i
        want.append((f"<urn:page:{'' if i is None else i}>", "revisit" if again else "response", f"<urn:page:{origin}>" if again else None,
                     len(data), hashlib.sha256(data).hexdigest()))
    assert found.count() > 2 * len(want)
    assert bag(got) == bag(want)


def test_long_payloads_are_in_files_of_their_own(spark, make, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 64_000)
    pages = [(i, "u", f"{i} " * (20 if i % 9 else 3_000)) for i in range(300)] + [(1000, "u", "z" * 200_000), (1001, "u", TRAP * 900), (1002, "u", None)]
    folder = f"{shared_folder(spark)}/t-{uuid.uuid4().hex}"
    warc.write_archives(make("page_id long, url string, html string", pages).coalesce(1), folder)
    sizes = [r.length for r in spark.read.format("binaryFile").load(folder).select("length").collect()]
    assert sum(s > 100_000 for s in sizes) == 2 and max(s for s in sizes if s < 100_000) <= 90_000
    want = bag((f"<urn:page:{i}>", len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest()) for i, _, h in pages)
    assert bag((r.id, r.bytes, r.digest) for r in warc.read_archives(spark, folder).collect()) == want


def test_no_pages_no_records(spark, make):
    folder = f"{shared_folder(spark)}/t-{uuid.uuid4().hex}"
    warc.write_archives(make("page_id long, url string, html string", []), folder)
    assert warc.read_archives(spark, folder).collect() == []


def check_shards(rows, shards=8):
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert set(by) <= set(range(shards))
    for members in by.values():
        assert sorted(r.slot for r in members) == list(range(len(members)))
    return {k: sum(r["size"] for r in v) for k, v in by.items()}


def test_shards_of_documents(spark, documents):
    rows = op6_sharding(spark, SMALL).collect()
    texts = {r.doc_id: (r.text or "").encode() for r in documents.select("doc_id", "text").collect()}
    assert bag((r.doc_id, r["size"], r.text_crc32) for r in rows) == bag((i, len(t) + 1, zlib.crc32(t)) for i, t in texts.items())
    sizes = check_shards(rows)
    largest = max(len(t) for t in texts.values())
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 2 * largest
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}


def test_hot_text_is_split_and_equal_texts_are_neighbours(make):
    rows = [(i, "hot text" if i % 2 else f"text {i}", "z") for i in range(4000)]
    out = shard_documents(make("doc_id long, text string, slot string", rows)).collect()
    sizes = check_shards(out)
    assert max(sizes.values()) <= 1.05 * sum(sizes.values()) / 8
    hot = sorted({r.shard for r in out if r.text == "hot text"})
    assert hot == list(range(hot[0], hot[-1] + 1)) and 3 < len(hot) < 8


def test_a_row_that_is_half_of_the_table_is_split(make):
    rows = [(7, "the same row again") if i % 2 else (i, f"some other text {i}") for i in range(8000)]
    sizes = check_shards(shard_documents(make("doc_id long, text string", rows)).collect())
    mean = sum(sizes.values()) / 8
    assert len(sizes) == 8 and all(abs(s - mean) <= 0.01 * mean + 30 for s in sizes.values())


def test_shards_of_odd_rows(make):
    rows = [(None, None), (None, None), (1, ""), (1, ""), (2, "x" * 100_000), (3, "y")]
    df = make("doc_id long, text string", rows)
    out = shard_documents(df).collect()
    check_shards(out)
    assert bag((r.doc_id, r.text) for r in out) == bag(rows)
    assert shard_documents(df.limit(0)).collect() == []


def test_splitters_are_exact(spark):
    rows = spark.range(1000).select((F.xxhash64("id").bitwiseAND(F.lit((1 << 63) - 1))).alias("k"), (F.col("id") % 7 + 1).alias("w"))
    cuts = splitters(rows, "k", "w", [0.25, 0.5], tolerance=0.0)
    held = sorted((r.k, r.w) for r in rows.collect())
    total = sum(w for _, w in held)
    for cut, share in zip(cuts, (0.25, 0.5)):
        assert abs(sum(w for k, w in held if k < cut) - share * total) <= 7


def test_ranks_and_prefix_sums(spark):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"))
    assert all(r.place == r.a for r in ranked(df, "place", "a").collect())
    got = prefix_sums(df, "before", "a", "g", "a").collect()
    for r in got:
        assert r.before == sum(x.a for x in got if x.g == r.g and x.a < r.a)


def test_mix_matches_sql(spark, con):
    assert bag(op7_source_mix(spark, SMALL).collect()) == bag(con.execute(OP7_SQL).fetchall())


def test_targets_are_shared_until_none_is_above(make):
    sizes = make("source string, source_size long", [("a", 10), ("b", 1000), ("c", 500), (None, 100), ("d", 0)])
    got = {r.source: r.target for r in targets(sizes).collect()}
    # weights 5, 2, 1, 5 (d), 2 (null): a and d are full at 3 times their size, then null, the rest by 2 to 1
    assert got["a"] == 30 and got["d"] == 0 and got[None] == 300
    assert got["b"] == pytest.approx(1280 * 2 / 3) and got["c"] == pytest.approx(1280 / 3)


def test_mix_keeps_to_targets_and_reruns_agree(make):
    rows = [(f"r{i}", "hot" if i % 3 else "x", 1 + i % 9, 1.0 if i % 2 else 2.0) for i in range(3000)] + [("n", None, 0, 1.0)] * 2
    df = make("rid string, source string, size long, quality double", rows)
    one, two = mix_rows(df).collect(), mix_rows(df.repartition(7)).collect()
    assert bag(one) == bag(two) and len(one) == len(rows)
    for source in ("hot", "x", None):
        mine = [r for r in one if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 9
        assert all(r.taken in (0, r["size"], 2 * r["size"], 3 * r["size"]) for r in mine)


def test_mixed_documents(make, spark):
    docs = make("doc_id long, text string, lang string, source string, n_chars long, rid string",
                [(i, "w " * (1 + i % 5), "en", "ab"[i % 2], 1, "z") for i in range(200)] + [(None, None, None, None, None, "z"), (7, "", None, "a", 0, "z")])
    labels = make("doc_id long, quality int, toxic int", [(1, 1, 0), (1, 0, 0), (None, 1, 0), (3, 0, 1)])
    out = mix_documents(docs, labels)
    assert out.columns == docs.columns
    words = out.agg(F.sum(F.size(F.split(F.trim("text"), " ")))).first()[0]
    assert abs(words - sum(1 + i % 5 for i in range(200))) <= 10
    assert mix_documents(docs.limit(0), labels).collect() == []
