"""Small helpers that the operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from morbidity.sources.writers import stage

BLANKS = r"[\x20\x09-\x0D]+"  # what parts words
PART = 65_536  # code points of a text that are handled at once
BATCH = 4 << 20  # bytes of rows that go to a Python worker at once


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*(columns or "*"))


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package under the path it has here.

    On a cluster where that path is missing, pass the package with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def n_bytes(text):
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def _in_pieces(rows: DataFrame, *order: str) -> DataFrame:
    """Staged in pieces of the given order, with ``__at``: piece number times 2 ** 33, plus the place in the piece."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(dealt.withColumn("__at", F.monotonically_increasing_id()), "pieces")


def ranked(rows: DataFrame, name: str, *order: str) -> DataFrame:
    """Adds the rank (from 0) in the given order, without one task for all rows: Spark deals rows into ranges, a place in
    the range is known in its task, and the ranges' sizes give the rest. Rows that agree in the order get ranks in any order."""
    pieces = _in_pieces(rows, *order).withColumn("__piece", F.shiftright("__at", 33))
    sizes = pieces.groupBy("__piece").agg(F.count("*").alias("__n"))  # one row a range
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("__piece", before.alias("__before"))
    place = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    joined = pieces.join(offsets, "__piece").withColumn(name, F.col("__before") + place)
    return joined.drop("__piece", "__at", "__before")


def prefix_sums(rows: DataFrame, name: str, value: str, by: str, *order: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows of the same ``by`` that come earlier in the order, in balanced pieces:
    a group of any size is summed piece by piece, then the pieces' sums are added up. Null is a group."""
    pieces = _in_pieces(rows, by, *order).withColumn("__piece", F.shiftright("__at", 33))
    sums = pieces.groupBy("__piece", by).agg(F.sum(value).alias("__n"))
    earlier = Window.partitionBy(by).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("__piece", F.col(by).alias("__by"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    above = Window.partitionBy("__piece", by).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    inside = pieces.withColumn("__inside", F.coalesce(F.sum(value).over(above), F.lit(0)))
    joined = inside.join(offsets, (inside["__piece"] == offsets["__piece"]) & inside[by].eqNullSafe(offsets["__by"])).drop(offsets["__piece"])
    return joined.withColumn(name, F.col("__before") + F.col("__inside")).drop("__piece", "__at", "__before", "__inside", "__by")


def arrow_map(rows: DataFrame, work: Callable, schema) -> DataFrame:
    """``rows.mapInArrow`` with batches of at most some ``BATCH`` bytes: Spark's own bound is 64 MB, which stands in the JVM, in its buffers and in the worker
    at the same time. A smaller setting of the session stays; Spark reads it when the job starts."""
    conf, key = rows.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    held = str(conf.get(key))
    if not held.isdigit() or not 0 < int(held) <= BATCH:
        conf.set(key, str(BATCH))
    return rows.mapInArrow(work, schema)


def by_batch(make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], most: float = 8e6):
    """For mapInArrow: ``make`` runs once per task, what it returns once per batch.

    A batch of many long texts is cut into slices of some ``most`` bytes, so that a task's memory doesn't grow with them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            rows = max(1, min(batch.num_rows, int(batch.num_rows * most / max(1, batch.nbytes))))
            for at in range(0, batch.num_rows, rows):
                yield work(batch.slice(at, rows))

    return run
