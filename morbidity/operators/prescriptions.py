"""Constipation and pain, diagnosed from repeated prescriptions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from morbidity.config import SOURCE_GP, Config
from morbidity.functions.nulls import drop_where
from morbidity.operators.joins import lookup_join

# fixed values
CONSTIPATION_LIST = "CON150"
CONSTIPATION, PAIN = "Constipation", "Pain"


def first_date(obs: DataFrame, codes: DataFrame, cfg: Config) -> DataFrame:
    """Earliest own-history date per patient of any of the codes."""
    own = (F.col("obstypeid") != cfg.family_history) & (F.col("obsdate") <= F.lit(cfg.end))
    listed = lookup_join(obs.where(own), codes.select("medcodeid").distinct(), "medcodeid", "left_semi")
    return listed.groupBy("patid").agg(F.min("obsdate").alias("epi_diag_date"))


def rx_candidates(drugs: DataFrame, prodcodes: DataFrame, cfg: Config) -> DataFrame:
    """Distinct issues of studied products, where a patient has enough issues of a list over all time.

    Issues are counted before repeats are dropped; the count rides along with the distinct, so one
    aggregation and one window do both. What is left is dealt out by patient once, for this window and
    for the joins and windows that follow.
    """
    issued = drugs.where(F.col("issuedate") <= F.lit(cfg.end)).select("patid", "prodcodeid", "issuedate")
    listed = lookup_join(issued, prodcodes.select("prodcodeid", "cond"), "prodcodeid")
    once = listed.groupBy("patid", "cond", "issuedate", "prodcodeid").agg(F.count(F.lit(1)).alias("n"))
    once = once.repartition("patid")
    total = F.sum("n").over(Window.partitionBy("patid", "cond"))
    return once.withColumn("n", total).where(F.col("n") >= cfg.rx_min_count).drop("n")


def rx_flag(rx: DataFrame, cfg: Config) -> DataFrame:
    """1 when this issue and the next three lie within a year."""
    w = Window.partitionBy("patid", "cond").orderBy("issuedate", "prodcodeid")
    later = F.lead("issuedate", cfg.rx_min_count - 1).over(w)
    return rx.withColumn("flag", F.when(F.datediff(later, "issuedate") <= cfg.rx_days, 1).otherwise(0))


def exclude_after(rx: DataFrame, first: DataFrame, cond: str) -> DataFrame:
    """Drop issues of one list from a patient's first date on; patients without a date keep all."""
    late = (F.col("cond") == cond) & (F.col("issuedate") >= F.col("epi_diag_date"))
    return rx.join(first, "patid", "left").where(drop_where(late)).drop("epi_diag_date")


def rx_spells(rx: DataFrame, cfg: Config) -> DataFrame:
    """Runs of flagged issues: first issue to a year after the last flagged one.

    Both pain lists run interleaved, by date, then list, then product.
    """
    name = F.when(F.col("cond") == CONSTIPATION_LIST, F.lit(CONSTIPATION)).otherwise(F.lit(PAIN))
    w = Window.partitionBy("patid", "list_disease_real").orderBy("issuedate", "cond", "prodcodeid")
    changes = F.when(F.col("flag") != F.lag("flag", 1, 0).over(w), 1).otherwise(0)
    runs = (
        rx.withColumn("list_disease_real", name)
        .withColumn("change", changes)
        .withColumn("run", F.sum("change").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    )
    return (
        runs.where("flag = 1")
        .groupBy("patid", "list_disease_real", "run")
        .agg(F.min("issuedate").alias("diag_date"), F.max("issuedate").alias("latest"))
        .select(
            "patid",
            "list_disease_real",
            "diag_date",
            F.date_add("latest", cfg.rx_days).alias("remission_date"),
            F.lit(cfg.rx_days).alias("disease_duration"),
            F.lit(SOURCE_GP).alias("source"),
        )
    )
