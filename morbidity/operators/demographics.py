"""Ethnicity and deprivation of a patient."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from morbidity.config import SOURCE_GP, SOURCE_HOSPITAL, Config
from morbidity.functions.nulls import strict_max
from morbidity.operators.diagnosis import event_date
from morbidity.operators.joins import lookup_join

UNKNOWN = "Unknown"
RECORD = ("patid", "obsdate", "HES_ethnic_group", "HES_category", "source")


def hospital_ethnicity(
    episodes: DataFrame, attendances: DataFrame, outpatients: DataFrame, lookup: DataFrame
) -> DataFrame:
    """Known ethnic groups recorded at inpatient, emergency and outpatient contacts."""
    dated = ((episodes, "admidate"), (attendances, "arrivaldate"), (outpatients, "apptdate"))
    parts = [
        df.select("patid", event_date(df, d).alias("obsdate"), F.col("ethnos").alias("HES_ethnic_group"))
        for df, d in dated
    ]
    known = parts[0].unionByName(parts[1]).unionByName(parts[2]).where(F.col("HES_ethnic_group") != UNKNOWN)
    joined = lookup_join(known, lookup.select("HES_ethnic_group", "HES_category"), "HES_ethnic_group")
    return joined.withColumn("source", F.lit(SOURCE_HOSPITAL)).select(*RECORD).distinct()


def gp_ethnicity_codes(obs: DataFrame, code_lookup: DataFrame, cfg: Config) -> DataFrame:
    """Ethnicity codes in general practice, family history left out: the interim table."""
    own = obs.where(F.col("obstypeid") != cfg.family_history).select("patid", "obsdate", "medcodeid")
    return (
        lookup_join(own, code_lookup, "medcodeid")
        .select("patid", "obsdate", "Term", "Group1", "Group2", "Group3")
        .withColumn("source", F.lit(SOURCE_GP))
    )


def gp_ethnicity(obs: DataFrame, code_lookup: DataFrame, hes_lookup: DataFrame, cfg: Config) -> DataFrame:
    """The same, in hospital categories; a category with several groups yields a row for each."""
    codes = gp_ethnicity_codes(obs, code_lookup, cfg)
    category = codes.select("patid", "obsdate", F.col("Group2").alias("HES_category"), "source").distinct()
    return lookup_join(category, hes_lookup.select("HES_category", "HES_ethnic_group"), "HES_category").select(
        *RECORD
    )


def modal_value(df: DataFrame, key: str, value: str, date: str) -> DataFrame:
    """Most frequent value per key; a tie goes to the most recent, then to the first by name.

    Counted before anything is gathered by key, so the window sees one row per (key, value). A tie in which
    no value has all its dates leaves the key out.
    """
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"), strict_max(F.col(date)).alias("last"))
    by_key = Window.partitionBy(key)
    order = by_key.orderBy(F.desc("n"), F.desc_nulls_last("last"), F.asc(value))
    top = F.max("n").over(by_key)
    return (
        counts.withColumn("top", top)
        .where("n = top")
        .withColumns({"ties": F.count(F.lit(1)).over(by_key), "pos": F.row_number().over(order)})
        .where("pos = 1 and (ties = 1 or last is not null)")
        .select(key, value)
    )


def patient_table(patients: DataFrame, imd: DataFrame, ethnicity: DataFrame) -> DataFrame:
    """Patients with a deprivation row, and their ethnicity where there is one."""
    decile = imd.select("patid", F.col("imd2015_decile").cast("int").alias("imd2015_decile"))
    named = ethnicity.select("patid", F.col("HES_ethnic_group").alias("ethnicity"))
    return patients.join(decile, "patid").join(named, "patid", "left")
