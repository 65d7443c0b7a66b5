"""Cleaning rules for event dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from morbidity.config import Config


def clean_observation_dates(obs: DataFrame, cfg: Config) -> DataFrame:
    """A missing or implausible date gives way to the entry date; rows left without a plausible one go."""
    lo, hi = F.lit(cfg.plausible_from), F.lit(cfg.plausible_to)
    seen, entered = F.coalesce("obsdate", "enterdate"), F.col("enterdate")
    date = F.when(seen.between(lo, hi), seen).when(entered.between(lo, hi), entered)
    return obs.withColumn("obsdate", date).where(F.col("obsdate").isNotNull())


def clean_birth_year(obs: DataFrame, patients: DataFrame) -> DataFrame:
    """A date before the year of birth gives way to the entry date, or the row goes. Adds yob.

    Patients outside the table, or without a birth year, lose their rows.
    """
    seen, entered, yob = F.col("obsdate"), F.col("enterdate"), F.col("yob")
    date = F.when(F.year(seen) >= yob, seen).when(F.year(entered) >= yob, entered)
    joined = obs.join(patients.select("patid", "yob"), "patid")
    return joined.withColumn("obsdate", date).where(F.col("obsdate").isNotNull())


def fill_date(df: DataFrame, target: str, fallback: str) -> DataFrame:
    return df.withColumn(target, F.coalesce(target, fallback))


def outpatient_diagnoses(clinical: DataFrame, appointments: DataFrame) -> DataFrame:
    """Outpatient diagnoses with the date of their appointment."""
    dates = appointments.select("patid", "attendkey", "apptdate")
    return clinical.join(dates, ["patid", "attendkey"])
