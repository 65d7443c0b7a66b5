"""Shards of near equal bytes by histogram sort.

Rows are ordered by a 63-bit key: the upper half from the text, so that equal texts lie together, then 20 bits from
the id and 12 from the row's place in the table, so that a large group of equal texts, or of one repeated row, can be split. Each splitter starts with all keys as its interval. A round
counts, over all partitions, the exact bytes below evenly spaced probes in all intervals at once, and keeps of each interval the part
between the two probes around its target. When each splitter is within tolerance, or its interval is one key, every
row knows its shard, and rows are exchanged once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from morbidity.llm.common import n_bytes, ranked, table
from morbidity.sources.writers import stage

SHARDS = 8
KEY_BITS = 63
ROUND_BITS = 9  # 512 probes an interval and round, so at most seven rounds
TOLERANCE = 0.002  # of a shard's weight


def sort_key(text="text", doc_id="doc_id"):
    """Null text and null id are values of their own. The place is that of the scan: stable while the table's files and the session's
    settings are; where it is not, rows that repeat may change places with each other, and with nothing else."""
    upper = F.shiftleft(F.xxhash64(F.lit(1), text).bitwiseAND(F.lit(0x7FFFFFFF)), 32)
    place = F.xxhash64(F.lit(3), F.monotonically_increasing_id())
    return upper.bitwiseOR(F.xxhash64(F.lit(2), doc_id).bitwiseAND(F.lit(0xFFFFF000))).bitwiseOR(place.bitwiseAND(F.lit(0xFFF)))


def splitters(rows: DataFrame, key: str, weight: str, shares: list[float], tolerance: float = TOLERANCE) -> list[int]:
    """For each share of the whole weight, the key below which nearest to that share lies.

    ``tolerance`` is relative to the smallest part between shares. The driver gets at most 512 sums per share and round.
    """
    edges = [0.0, *shares, 1.0]
    within = tolerance * min(b - a for a, b in zip(edges, edges[1:]))
    todo = {i: (0, 0) for i in range(len(shares))}  # share -> leading bits of its interval, weight below it
    found, shift, total = [0] * len(shares), KEY_BITS, None
    while todo and shift:
        step = min(ROUND_BITS, shift)
        inside = rows.where(F.shiftright(key, shift).isin(sorted({p for p, _ in todo.values()})))
        sums = inside.groupBy(F.shiftright(key, shift - step).alias("probe")).agg(F.sum(weight).alias("w")).collect()
        held = {r.probe: r.w for r in sums}
        total = sum(held.values()) if total is None else total
        shift -= step
        for i, (prefix, below) in list(todo.items()):
            target, at = shares[i] * total, prefix << step
            while at < ((prefix + 1) << step) - 1 and below + held.get(at, 0) <= target:
                below += held.get(at, 0)
                at += 1
            low, high = target - below, below + held.get(at, 0) - target
            if min(abs(low), abs(high)) <= within * total or not shift:
                found[i] = (at if abs(low) <= abs(high) else at + 1) << shift
                del todo[i]
            else:
                todo[i] = at, below
    return found


def shard_rows(rows: DataFrame, key: str, weight: str, shards: int = SHARDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1, in order of the key, near equal in weight) and ``slot`` (rank in the shard, from 0).

    Rows that agree in the key are not parted. Such columns of ``rows`` are replaced. ``rows`` is read once for each
    round, with key and weight alone, so it should be a stored table.
    """
    return _placed(rows.drop("shard", "slot"), rows, key, weight, shards, tolerance)


def _placed(rows: DataFrame, keys: DataFrame, key: str, weight: str, shards: int, tolerance: float) -> DataFrame:
    """The one exchange: rows in order of the key; ``keys`` is what the splitters are found from."""
    cuts = splitters(keys, key, weight, [i / shards for i in range(1, shards)], tolerance)
    shard = sum([(F.col(key) >= c).cast("int") for c in cuts], F.lit(0))
    placed = ranked(rows.withColumn("shard", shard), "__rank", key)
    first = placed.groupBy("shard").agg(F.min("__rank")).collect()  # one row a shard
    if not first:
        return placed.withColumnRenamed("__rank", "slot")
    start = F.create_map(*[F.lit(x) for pair in first for x in pair])[F.col("shard")]
    return placed.withColumn("slot", F.col("__rank") - start).drop("__rank")


def shard_documents(docs: DataFrame, shards: int = SHARDS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot``, dealt into shards of near equal bytes.

    A row's size is the UTF-8 bytes of its text (null: none) plus 1. Equal texts are neighbours, parted only where a splitter
    falls among them. Repeated rows stay, in 4,096 parts that a splitter may fall between. An empty table gives an empty one. Columns of these names are replaced.
    """
    sized = docs.withColumns({"size": n_bytes(text) + 1, "__key": sort_key(text, doc_id)})
    keys = stage(sized.select("__key", "size"), "keys")
    return _placed(sized.drop("shard", "slot"), keys, "__key", "size", shards, TOLERANCE).drop("__key")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (n_bytes("text") + 1).alias("size"), F.crc32(text).alias("text_crc32"), sort_key().alias("__key"))
    placed = shard_rows(stage(rows, "sizes"), "__key", "size")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
