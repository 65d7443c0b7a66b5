"""Token counts by a compiled transducer, over parts of texts that are put together afterwards."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from morbidity.llm.common import PART, by_batch, n_bytes, table
from morbidity.llm.token_fst import SPACE, transducer

MAP = "head string, tokens long, tail string, whole boolean"
LIMIT = 4096


def vocabulary(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def state_map(count, part: str) -> tuple[str, int, str, bool]:
    """What a part of a text does to any state: (head, tokens, tail, whole).

    The transducer is back at its start before a space that follows no space, and at line ends. ``head`` is the text up to the first such place,
    whose tokens depend on the state before; ``tokens`` those from there to the last such place; ``tail`` leads from
    the start to the state after the part. A part without such a place is ``whole``: all of it is head.
    """
    first = next((i for i in range(1, len(part)) if _back(part, i)), None)
    if first is None:
        return part, 0, "", True
    last = next(i for i in range(len(part) - 1, 0, -1) if _back(part, i))
    return part[:first], count(part[first:last]), part[last:], False


def _back(text: str, i: int) -> bool:
    return text[i] == "\n" or text[i - 1] == "\n" or (text[i] == SPACE and text[i - 1] != SPACE)


def compose(count, maps: list[tuple[str, int, str, bool]]) -> int:
    """Tokens of the parts in order. Composition is associative, so any grouping gives the same."""
    while len(maps) > 1:  # pairs, pairs of pairs, ...
        maps = [_two(count, *maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
    head, tokens, tail, _ = maps[0]
    return (count(head) if head else 0) + tokens + (count(tail) if tail else 0)


def _two(count, a, b):
    middle = (a[0] if a[3] else a[2]) + b[0]
    head, tokens, tail, whole = inner = state_map(count, middle)
    if a[3] and b[3]:
        return inner
    if a[3]:  # what b needs to know of the state before it ends in the middle
        return (middle, b[1], b[2], False) if whole else (head, tokens + count(tail) + b[1], b[2], False)
    if b[3]:
        return (a[0], a[1], middle, False) if whole else (a[0], a[1] + count(head) + tokens, tail, False)
    return a[0], a[1] + count(middle) + b[1], b[2], False


def count_tokens(
    docs: DataFrame, vocab: str, text: str = "text", keep: list[str] | None = None, part: int = PART
) -> DataFrame:
    """The rows of ``docs`` with ``n_tokens``; columns ``keep`` (all, if None), a column of that name is replaced.

    Texts are cut into parts of ``part`` code points, which go through the transducer on their own; the parts' state
    maps (two ends and a number, not the text) are then gathered by row and composed. A null or empty text has no
    tokens. Rows that repeat are counted each. ``vocab`` is a sentencepiece BPE model, present under this path on
    every executor. Python is used because the transducer's tables don't fit in an expression.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c != "n_tokens"]
    whole = F.coalesce(F.col(text), F.lit(""))
    length = F.length(whole)
    cut = F.when(length <= part, F.array(whole)).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.floor((length - 1) / part).cast("int")),
            lambda i: F.substring(whole, i * part + 1, F.lit(part)),
        )
    )
    rows = docs.select(
        F.monotonically_increasing_id().alias("__row"), F.struct(*kept).alias("__kept"), cut.alias("__cuts")
    )
    parts = rows.select("__row", "__kept", F.posexplode("__cuts").alias("__part", "__cut"))
    first = F.when(F.col("__part") == 0, F.col("__kept")).alias("__kept")  # one part is enough to carry the row
    parts = parts.select("__row", "__part", first, "__cut")
    found = T.StructType([*parts.schema.fields[:3], *T._parse_datatype_string(MAP).fields])

    def start():
        count = transducer(vocab).count

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            numbers, texts = batch.column(1).to_pylist(), batch.column(3).to_pylist()
            maps = [
                state_map(count, (SPACE if k == 0 and t else "") + t.replace(" ", SPACE)) for k, t in zip(numbers, texts)
            ]
            columns = list(zip(*maps)) or [(), (), (), ()]
            kinds = pa.string(), pa.int64(), pa.string(), pa.bool_()
            made = [pa.array(c, k) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays([*batch.columns[:3], *made], names=found.names)

        return work

    gathered = (
        parts.mapInArrow(by_batch(start), found)
        .groupBy("__row")
        .agg(
            F.first("__kept", ignorenulls=True).alias("__kept"),
            F.sort_array(F.collect_list(F.struct("__part", "head", "tokens", "tail", "whole"))).alias("maps"),
        )
        .select("__kept", "maps")
    )
    counted = T.StructType([gathered.schema.fields[0], T.StructField("n_tokens", T.LongType())])

    def finish():
        count = transducer(vocab).count

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = batch.column(1).to_pylist()
            n = [compose(count, [(m["head"], m["tokens"], m["tail"], m["whole"]) for m in maps]) for maps in rows]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=counted.names)

        return work

    return gathered.mapInArrow(by_batch(finish), counted).select("__kept.*", "n_tokens")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("n_bytes", n_bytes("text"))
    sized = count_tokens(docs, vocabulary(), keep=["doc_id", "n_bytes"])
    return sized.withColumn("over_limit", F.col("n_tokens") > LIMIT)
