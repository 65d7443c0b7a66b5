"""Writers, and the stage that cuts a long lineage."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT_ORDER = ("fyear", "agecat_ord", "gender", "imd2015_decile")


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet, in folders by the given columns.

    Rows of a folder are brought together first, so that a folder gets few files; Spark splits a folder that
    is too large for one task.
    """
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to the folder came to its end; one that broke off leaves no ``_SUCCESS``."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def plan_print(df: DataFrame, known: str = "") -> str:
    """A hash of what a table is made from: its plan, whose expressions hold code and settings, and the names, sizes and times of the files
    that it reads. Files under ``known`` stand by name alone, because their names tell what they were made from. Data that was handed to Spark row by
    row is not looked at. Equal plans built in other sessions give the same."""
    conf, plan = df.sparkSession.conf, df._jdf.queryExecution().analyzed()
    before = conf.get("spark.sql.debug.maxToStringFields")
    conf.set("spark.sql.debug.maxToStringFields", 2**31 - 1)  # all columns
    try:
        text = re.sub(r"lambda \w+#", "lambda #", plan.treeString())
    finally:
        conf.set("spark.sql.debug.maxToStringFields", before)
    ids: dict[str, str] = {}
    text = re.sub(r"#(\d+)", lambda m: f"#{ids.setdefault(m[1], str(len(ids)))}", text)
    lines, leaves = [text], plan.collectLeaves()
    for leaf in (leaves.apply(i) for i in range(leaves.length())):
        if leaf.getClass().getSimpleName() != "LogicalRelation":
            continue
        location = leaf.relation().location()
        roots = [location.rootPaths().apply(i).toString() for i in range(location.rootPaths().length())]
        lines += sorted(roots)
        if known and all(known in r for r in roots):
            continue
        files = location.allFiles()
        seen = (files.apply(i) for i in range(files.length()))
        lines += sorted(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}" for f in seen)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


class Addressed:
    """Like ``stage``, under names in a folder that runs share: ``folder/name/print``, where the print tells what the table was made from
    (``plan_print``). A whole table of the same print is read, not made again. So a run that broke off goes on where it was, and after a change of files, code lists or
    settings a run makes anew what depends on it, and only that. Older tables stay until they are deleted."""

    def __init__(self, folder: str):
        self.folder = folder

    def path(self, df: DataFrame, name: str) -> str:
        return f"{self.folder}/{name}/{plan_print(df, self.folder)[:20]}"

    def has(self, df: DataFrame, name: str) -> bool:
        return finished(df.sparkSession, self.path(df, name))

    def __call__(self, df: DataFrame, name: str, on_write: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
        path = self.path(df, name)
        if not finished(df.sparkSession, path):
            on_write(df).write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)


def write_reports(reports: dict[str, DataFrame], path: str) -> None:
    """Report families as one table per family, in folders by report name. A report is one file, its rows in order: it has a row for each
    year and group, so it is small whatever the panel's size."""
    for family, report in reports.items():
        one_each = report.repartition(F.col("report")).sortWithinPartitions("report", *[c for c in REPORT_ORDER if c in report.columns])
        one_each.write.mode("overwrite").partitionBy("report").parquet(f"{path}/{family}")


def read_report(spark: SparkSession, path: str, family: str, report: str) -> DataFrame:
    """One report, without the key columns it does not use."""
    df = spark.read.parquet(f"{path}/{family}").where(F.col("report") == report)
    return df.drop("report")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a folder of its own only where the cluster names none."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="morbidity-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def bucket_count(spark: SparkSession, n_bytes: int, most: int = 128 << 20) -> int:
    """Buckets for a table of some bytes: none much larger than ``most``, and no fewer than a shuffle would have."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // most))


def bucketed(df: DataFrame, name: str, keys: list[str], n_bytes: int, sort: list[str] | None = None, n: int | None = None) -> DataFrame:
    """Like ``stage``, in buckets by ``keys``: later joins, aggregations and windows on the keys read it without an exchange.

    Rows are brought to their bucket first, so that each has one file. The table is registered under ``name`` in the session's catalog, with its
    files in the shared folder; dropping the table leaves them there.
    """
    spark = df.sparkSession
    n = n or bucket_count(spark, n_bytes)
    writer = df.repartition(n, *keys).write.option("compression", "zstd").bucketBy(n, *keys)
    if sort:
        writer = writer.sortBy(*sort)
    writer.option("path", f"{shared_folder(spark)}/stage/{name}").saveAsTable(name, format="parquet")
    return spark.table(name)


def by_key(key: str, n: int) -> Callable[[DataFrame, str], DataFrame]:
    """Like ``stage``; tables with the key are kept in ``n`` buckets by it, sorted, so that joins, aggregations and windows on the key need no exchange
    and joins of two such tables no sort either."""

    def keep(df: DataFrame, name: str) -> DataFrame:
        if key not in df.columns:
            return stage(df, name)
        return bucketed(df, f"{name}_{uuid.uuid4().hex}", [key], 0, [key], n)

    return keep


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write the table to the shared folder and read it back. Runs the plan of ``df`` once.

    Whatever uses the result later starts from files that survive the loss of any executor, knows its
    size and still prunes columns.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
