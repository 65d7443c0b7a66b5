"""WARC archives: written with repeats as revisits, and read back by verified chains of record boundaries.

A payload may hold what looks like the start of a record. Tasks therefore list every candidate with the place where the next
record must begin if it is one, and only what the chain from the file's start reaches counts. The chain is followed by
pointer jumping: in each round every pointer is replaced by its target's pointer, so a chain of n links takes log n rounds.
Links inside a range of a file are followed by the task that found them, so that n is the number of ranges.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from morbidity.llm.common import arrow_map, n_bytes, table
from morbidity.sources.writers import shared_folder, stage

LEAST = 100  # bytes of a payload from which its repeats are revisits
FILE_RECORDS = 1_000
FILE_BYTES = 32 << 20  # of payload in a file, unless a single record has more
RANGE = 1 << 18  # bytes of a file whose links one task follows
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_MAGIC = re.compile(rb"WARC/1\.[01]\r\n")
CANDIDATE = "file string, range int, at long, next long, leaves long, id string, kind string, refers string, bytes long, digest string"


def with_roles(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """``pages`` with ``__bytes``, ``__digest`` and ``__first``: the page whose payload this one repeats, or null.

    Null html is an empty payload. A page that shares the smallest id (repeated rows) repeats nothing; a null id is the largest.
    """
    sized = pages.withColumns({"__bytes": n_bytes(html), "__digest": F.sha2(F.coalesce(html, F.lit("")), 256)})
    repeated = (
        sized.where(F.col("__bytes") >= LEAST)
        .groupBy(F.col("__digest").alias("__d"))
        .agg(F.min(page_id).alias("__first"), F.count("*").alias("__n"))
        .where("__n > 1")
    )
    repeated = stage(repeated, "repeated")  # so that Spark knows its size, and shuffles payloads only if it is large
    joined = sized.join(repeated, F.col("__digest") == F.col("__d"), "left").drop("__d", "__n")
    own = F.col(page_id).eqNullSafe(F.col("__first"))
    return joined.withColumn("__first", F.when(~own, F.col("__first")))


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", file_records: int = FILE_RECORDS) -> None:
    """One record for each page, into files of at most ``file_records`` records, uncompressed.

    A task reads a file whole, so a file has no more than ``FILE_BYTES`` of payload, or one record: pages too large for ``file_records`` of
    them in a file are written apart, with a 32nd of the records in a file, then one. ``pages`` is read once for each of these three classes that it has;
    payloads are not shuffled.
    """
    rows = with_roles(pages, page_id, html)
    revisit = F.col("__first").isNotNull()
    block = F.concat(F.lit(HTTP), F.when(revisit, F.lit("")).otherwise(F.coalesce(html, F.lit(""))))
    target = F.regexp_replace(F.coalesce(F.col(url).cast("string"), F.lit("")), r"[\x00-\x20\x7F]", "%20")

    def name(c):
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))

    record = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "),
        name(page_id),
        F.lit("\r\nWARC-Target-URI: "),
        target,
        F.lit("\r\nWARC-Date: 2000-01-01T00:00:00Z\r\nWARC-Payload-Digest: sha256:"),
        F.col("__digest"),
        F.lit("\r\nX-Payload-Length: "),
        F.col("__bytes").cast("string"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Refers-To: "), name("__first"))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"),
        block,
        F.lit("\r\n"),
    )
    # the writer ends each row with the second of the two line ends that end a record
    largest, above, records = pages.agg(F.max(n_bytes(html))).first()[0] or 0, -1, file_records
    while above < largest or above < 0:
        upto = FILE_BYTES // records if records > 1 else largest
        some = rows.where((F.col("__bytes") > above) & (F.col("__bytes") <= upto))
        some.select(record.alias("value")).write.mode("append").option("lineSep", "\r\n").option("maxRecordsPerFile", records).text(folder)
        above, records = upto, max(1, records // 32)


def candidates(spark: SparkSession, folder: str, range_bytes: int = RANGE) -> DataFrame:
    """Whatever looks like a record: its file, range and place (``at``), where the next one begins (``next``), and where the
    chain from here leaves the range (``leaves``)."""

    def found_in(path: str, data: bytes) -> list[dict]:
        rows = []
        for m in _MAGIC.finditer(data):
            end = data.find(b"\r\n\r\n", m.end())
            if end < 0:
                continue
            pairs = [line.partition(b":") for line in data[m.end() : end].split(b"\r\n")]
            fields = {k.strip().lower(): v.strip().decode("utf-8", "replace") for k, _, v in pairs}
            length = fields.get(b"content-length", "")
            if not re.fullmatch("[0-9]{1,18}", length) or end + 4 + int(length) + 4 > len(data):
                continue
            after = end + 4 + int(length)
            if data[after : after + 4] != b"\r\n\r\n":
                continue
            row = {"file": path, "range": m.start() // range_bytes, "at": m.start(), "next": after + 4}
            row |= {"id": fields.get(b"warc-record-id"), "kind": fields.get(b"warc-type"), "refers": fields.get(b"warc-refers-to")}
            if row["kind"] == "revisit":
                size = fields.get(b"x-payload-length", "")
                row |= {"bytes": int(size) if size.isdigit() else None, "digest": fields.get(b"warc-payload-digest", "").removeprefix("sha256:")}
            else:
                start = data.find(b"\r\n\r\n", end + 4, after)
                payload = data[start + 4 if start >= 0 else end + 4 : after]
                row |= {"bytes": len(payload), "digest": hashlib.sha256(payload).hexdigest()}
            rows.append(row)
        leaves: dict[int, int] = {}
        for row in reversed(rows):
            same = row["next"] // range_bytes == row["range"]
            leaves[row["at"]] = row["leaves"] = leaves.get(row["next"], row["next"]) if same else row["next"]
        return rows

    fields = [pa.field(n, pa.int64() if t == "long" else pa.int32() if t == "int" else pa.string()) for n, t in (c.split() for c in CANDIDATE.split(", "))]

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                rows = found_in(batch.column(0)[k].as_py(), batch.column(1)[k].as_py())
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(fields))

    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return arrow_map(files, run, CANDIDATE)


def reached(found: DataFrame) -> DataFrame:
    """(file, at): the places where the chain from each file's start enters a range."""
    entered = stage(found.where("at = 0").select("file", "at"), "entered")
    jumps = found.select("file", "at", F.col("leaves").alias("to"))
    starts = found.select("file", F.col("at").alias("to"))
    jumps = stage(jumps.join(starts, ["file", "to"], "left_semi"), "jumps")  # pointers to the file's end lead nowhere
    while not jumps.isEmpty():
        further = entered.join(jumps, ["file", "at"]).select("file", F.col("to").alias("at"))
        entered = stage(entered.union(further).distinct(), "entered")
        onward = jumps.select("file", F.col("at").alias("to"), F.col("to").alias("beyond"))
        jumps = stage(jumps.join(onward, ["file", "to"]).select("file", "at", F.col("beyond").alias("to")), "jumps")
    return entered


def verified(found: DataFrame) -> DataFrame:
    """The candidates that the chain from the start of their file reaches. A group is what one range of a file holds."""
    narrow = stage(found.select("file", "range", "at", "next", "leaves"), "chain")
    entry = reached(narrow).withColumnRenamed("at", "entry")
    inside = narrow.groupBy("file", "range").agg(F.sort_array(F.collect_list(F.struct("at", "next"))).alias("links"))
    entries = narrow.select("file", "range", F.col("at").alias("entry")).join(entry, ["file", "entry"])
    joined = entries.join(inside, ["file", "range"])
    start = F.struct(F.col("entry").alias("next"), F.array().cast("array<bigint>").alias("kept"))
    kept = F.aggregate(
        "links",
        start,
        lambda a, x: F.when(x["at"] == a["next"], F.struct(x["next"].alias("next"), F.array_append(a["kept"], x["at"]).alias("kept"))).otherwise(a),
        lambda a: a["kept"],
    )
    places = joined.select("file", F.explode(kept).alias("at"))
    return found.join(places, ["file", "at"], "left_semi")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(id, kind, refers, bytes, digest) for each record; size and digest of a response are those of the payload read, of a revisit those it
    states. Bytes after a place where the chain breaks are not records."""
    found = stage(candidates(spark, folder), "candidates")
    return verified(found).select("id", "kind", "refers", "bytes", "digest")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, folder)

    def number(c):
        return F.expr(f"try_cast(regexp_extract({c}, '^<urn:page:(-?[0-9]+)>$', 1) as bigint)")

    return read_archives(spark, folder).select(
        number("id").alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        number("refers").alias("refers_to"),
    )


OP4_SQL = """
with p as (
  select page_id, coalesce(html, '') as html, cast(octet_length(encode(coalesce(html, ''))) as bigint) as payload_bytes,
    sha256(coalesce(html, '')) as payload_digest from pages),
f as (select *, min(page_id) over (partition by payload_digest) as first from p)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and first is distinct from page_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and first is distinct from page_id then first end as refers_to
from f
"""
