"""A panel kept up to date: after a change of the input, only the buckets of patients that it concerns are made again.

Patients are dealt to a fixed number of buckets. A bucket's print sums hashes of all rows of its patients, table by table, whatever their order; tables without
patients, and the settings, are part of every print. Links between patients (one registration for each hospital person) are resolved
before: a bucket's print holds its eligible patients as they come out, in place of the tables that these are made from.

Bucket files are never changed. A run writes new ones and then a list of the run whose files hold each bucket; readers go by the newest whole
list, so that a run that breaks off changes nothing.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import fields, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from morbidity.config import Config
from morbidity.plans import study
from morbidity.sources.writers import finished, stage

RESOLVED = ("patient", "hospital_link", "death_register", "practice")  # what eligible patients are made from


def _bucket(n: int):
    return F.pmod(F.hash("patid"), F.lit(n))


def _sum(df: DataFrame):
    """Rows and the sums of both halves of their hashes, exact in any order; doubles and dates hash by their bits. Longs hold the sums of 2^31 rows; beyond
    that Spark raises an error where it is set to ANSI, and goes on modulo 2^64 elsewhere."""
    h = F.xxhash64(*df.columns)
    return F.concat_ws(":", F.count(F.lit(1)), F.sum(F.shiftright(h, 32)), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))))


def prints(t: study.Tables, eligible: DataFrame, cfg: Config, n: int) -> DataFrame:
    """(bucket, print) for each bucket with any row. Each table is scanned once; what is shuffled is a row for each bucket and task."""
    own, common = {"eligible": eligible}, {}
    for f in fields(t):
        df = getattr(t, f.name)
        if df is not None and f.name not in RESOLVED:
            (own if "patid" in df.columns else common)[f.name] = df
    shared = [repr(cfg), *(f"{k} {df.agg(_sum(df).alias('s')).first().s}" for k, df in sorted(common.items()))]  # a row each
    salt = hashlib.sha256("\n".join(shared).encode()).hexdigest()
    each = [
        df.groupBy(_bucket(n).alias("bucket")).agg(_sum(df).alias("s")).select("bucket", F.concat_ws(" ", F.lit(k), "s").alias("s"))
        for k, df in sorted(own.items())
    ]
    whole = reduce(DataFrame.unionByName, each).where("bucket is not null").groupBy("bucket")
    return whole.agg(F.sha2(F.concat_ws("\n", F.lit(salt), F.sort_array(F.collect_list("s"))), 256).alias("print"))


def newest(spark: SparkSession, folder: str) -> tuple[int, DataFrame | None]:
    """Number and content (bucket, print, run) of the newest whole list."""
    k = 0
    while finished(spark, f"{folder}/lists/{k + 1}"):
        k += 1
    return k, spark.read.schema("bucket int, print string, run string").parquet(f"{folder}/lists/{k}") if k else None


def current(spark: SparkSession, folder: str) -> DataFrame:
    """The panel as the newest list has it. The list has a row for each bucket; Spark reads the files of its runs and buckets alone."""
    _, now = newest(spark, folder)
    if now is None:
        raise ValueError(f"no panel in {folder}")
    panel = spark.read.parquet(f"{folder}/panel")
    return panel.join(now.select("run", "bucket"), ["run", "bucket"], "left_semi").drop("run", "bucket")


def refresh(t: study.Tables, cfg: Config, folder: str, n: int = 1024) -> DataFrame:
    """Brings the panel in the folder up to date with the tables and settings, and returns it. ``n`` must stay the same for a folder."""
    spark = t.patient.sparkSession
    eligible = stage(study.eligible_patients(t, cfg), "patients")
    now = stage(prints(t, eligible, cfg, n), "prints")
    k, before = newest(spark, folder)
    before = before if before is not None else spark.range(0).selectExpr("cast(id as int) as bucket", "'' as print", "'' as run")
    both = now.join(before.withColumnRenamed("print", "old"), "bucket", "left")
    changed = [r.bucket for r in both.where(~F.col("print").eqNullSafe(F.col("old"))).select("bucket").collect()]  # n at most
    run = uuid.uuid4().hex
    if changed:
        mine = lambda df: df.where(_bucket(n).isin(changed))
        own = {f.name: getattr(t, f.name) for f in fields(t)}
        part = replace(t, **{m: mine(df) for m, df in own.items() if df is not None and "patid" in df.columns})
        made = study.panel_of(part, mine(eligible), cfg)
        dealt = made.withColumns({"run": F.lit(run), "bucket": _bucket(n)})
        dealt.hint("rebalance", "bucket").write.mode("append").partitionBy("run", "bucket").parquet(f"{folder}/panel")
    kept = F.when(F.col("print").eqNullSafe(F.col("old")), F.col("run")).otherwise(F.lit(run))
    both.select("bucket", "print", kept.alias("run")).coalesce(1).write.mode("overwrite").parquet(f"{folder}/lists/{k + 1}")
    return current(spark, folder)
