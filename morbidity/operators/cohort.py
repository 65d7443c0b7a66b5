"""Who is studied, and from when until when."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from morbidity.config import Config


def drop_duplicate_practices(patients: DataFrame, cfg: Config) -> DataFrame:
    return patients.where(~F.col("pracid").isin(*cfg.duplicate_practices))


def dedupe_linked(patients: DataFrame, links: DataFrame) -> DataFrame:
    """One registration per hospital person; patients without a hospital id are all kept.

    The latest start wins, then the latest end (a missing end loses), then the highest patid. ``max`` of a
    struct combines map-side, so one person with a great many registrations is no hot task.
    """
    named = patients.join(links.where("gen_hesid is not null").select("patid", "gen_hesid"), "patid", "left")
    order = ["regstartdate", "regenddate", "patid"]
    row = F.struct(*order, *[c for c in patients.columns if c not in order])
    alone = F.when(F.col("gen_hesid").isNull(), F.col("patid")).alias("alone")
    latest = named.groupBy("gen_hesid", alone).agg(F.max(row).alias("row"))
    return latest.select("row.*").select(*patients.columns)


def with_death_date(patients: DataFrame, register: DataFrame, cfg: Config) -> DataFrame:
    """The register's date of death; the practice's own only without one and after the cut-off.

    A patient listed twice in the register counts once: best match rank, then earliest date.
    """
    rank, dod = F.col("match_rank"), F.col("dod")
    best = F.min(F.struct(rank.isNull().alias("a"), rank.alias("b"), dod.isNull().alias("c"), dod.alias("dod")))
    once = register.groupBy("patid").agg(best.alias("best")).select("patid", "best.dod")
    gp = F.when(F.col("cprd_ddate") > F.lit(cfg.gp_death_after), F.col("cprd_ddate"))
    return patients.join(once, "patid", "left").withColumn("death_date", F.coalesce(dod, gp)).drop("dod")


def with_practice(patients: DataFrame, practices: DataFrame, cfg: Config) -> DataFrame:
    """Region and last collection date of the practice. Spark broadcasts the practices if they are small."""
    region = F.col("region")
    for pracid, value in cfg.region_overrides.items():
        region = F.when(F.col("pracid") == pracid, F.lit(value)).otherwise(region)
    fixed = practices.select("pracid", region.cast("int").alias("region"), "lcd")
    return patients.join(fixed, "pracid", "left")


def with_censor_date(patients: DataFrame, cfg: Config) -> DataFrame:
    """Follow-up ends at the first of registration end, death, last collection and study end."""
    ended = F.coalesce("regenddate", "death_date")
    return patients.withColumn("regenddate", ended).withColumn(
        "censor_date", F.least("regenddate", "death_date", "lcd", F.lit(cfg.end))
    )


def valid_follow_up(patients: DataFrame) -> DataFrame:
    return patients.where(F.col("censor_date") > F.col("regstartdate"))


def with_bucket(patients: DataFrame, n: int) -> DataFrame:
    """Stable bucket of a patient, for partitioned output. No patient is dropped."""
    return patients.withColumn("bucket", F.pmod(F.xxhash64("patid"), F.lit(n)).cast("int"))
