"""Diagnoses by condition, from hospital and general practice records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from morbidity.config import PERMANENT_FROM, SOURCE_GP, SOURCE_HOSPITAL, Config
from morbidity.functions.dates import parse_day_first
from morbidity.functions.nulls import if_known
from morbidity.functions.text import outpatient_icd
from morbidity.operators.joins import lookup_join

HOSPITAL = ("patid", "obsdate", "list_disease_real", "disease_duration", "source", "remission_date")
OUTPATIENT_CODES = ("diag_01", "diag_02", "diag_03")


def event_date(df: DataFrame, name: str) -> Column:
    """A date column as it is, day-month-year text parsed."""
    return parse_day_first(F.col(name)) if dict(df.dtypes)[name] == "string" else F.col(name)


def _hospital_rows(coded: DataFrame, icd_lookup: DataFrame, cfg: Config) -> DataFrame:
    found = lookup_join(coded, icd_lookup.where("ICD10code is not null"), "ICD10code")
    days = F.col("disease_duration")
    ends = if_known(days < PERMANENT_FROM, F.date_add("obsdate", days), F.lit(cfg.end))
    return found.withColumns({"source": F.lit(SOURCE_HOSPITAL), "remission_date": ends}).select(*HOSPITAL)


def inpatient_rows(diag: DataFrame, icd_lookup: DataFrame, cfg: Config) -> DataFrame:
    """Inpatient diagnoses in the lookup, repeats included."""
    coded = diag.select("patid", event_date(diag, "epistart").alias("obsdate"), F.col("icd").alias("ICD10code"))
    return _hospital_rows(coded, icd_lookup, cfg)


def outpatient_codes(clinical: DataFrame, cfg: Config) -> DataFrame:
    """One row per filled diagnosis field, the code rewritten to the form of the lookup."""
    kept = [c for c in clinical.columns if c not in OUTPATIENT_CODES]
    long = clinical.select(*kept, F.explode(F.array(*OUTPATIENT_CODES)).alias("icd")).where("icd != ''")
    return long.select(*kept, outpatient_icd(F.col("icd"), cfg.fix_icd).alias("ICD10code"))


def outpatient_rows(clinical: DataFrame, appointments: DataFrame, icd_lookup: DataFrame, cfg: Config) -> DataFrame:
    """Outpatient diagnoses in the lookup with the date of their appointment, repeats included.

    Most codes are not in the lookup, so it is joined first: only what it leaves is shuffled to meet the appointments.
    """
    listed = outpatient_codes(clinical, cfg).join(icd_lookup.select("ICD10code"), "ICD10code", "left_semi")
    dates = appointments.select("patid", "attendkey", event_date(appointments, "apptdate").alias("obsdate"))
    dated = listed.join(dates, ["patid", "attendkey"]).select("patid", "obsdate", "ICD10code")
    return _hospital_rows(dated, icd_lookup, cfg)


def inpatient_dx(diag: DataFrame, icd_lookup: DataFrame, cfg: Config) -> DataFrame:
    return inpatient_rows(diag, icd_lookup, cfg).distinct()


def outpatient_dx(clinical: DataFrame, appointments: DataFrame, icd_lookup: DataFrame, cfg: Config) -> DataFrame:
    return outpatient_rows(clinical, appointments, icd_lookup, cfg).distinct()


def hospital_dx(inpatient: DataFrame, outpatient: DataFrame, patients: DataFrame, cfg: Config) -> DataFrame:
    """Both hospital sources, once each, up to the study end, for listed patients.

    Repeats go first: a patient then has at most one row per day and condition when the patients join.
    """
    both = inpatient.unionByName(outpatient).where(F.col("obsdate") <= F.lit(cfg.end)).distinct()
    return both.join(patients.select("patid"), "patid", "left_semi")


def gp_events(obs: DataFrame, cfg: Config) -> DataFrame:
    """Own (not family) history up to the study end."""
    own = (F.col("obstypeid") != cfg.family_history) & (F.col("obsdate") <= F.lit(cfg.end))
    return obs.where(own).select("patid", "medcodeid", "obsdate")


def coded_only(obs: DataFrame, codelist: DataFrame) -> DataFrame:
    """Observations whose code is listed."""
    return lookup_join(obs, codelist.select("medcodeid").distinct(), "medcodeid", "left_semi")


def gp_dx(obs: DataFrame, codelist: DataFrame, cfg: Config) -> DataFrame:
    return gp_events(coded_only(obs, codelist), cfg).distinct()


def _conditions(gp: DataFrame, codelist: DataFrame, names: tuple[str, ...]) -> DataFrame:
    listed = codelist.where(F.col("list_disease_real").isin(*names))
    codes = listed.select("medcodeid", "list_disease_real", "read")
    return lookup_join(gp, codes, "medcodeid").withColumn("source", F.lit(SOURCE_GP))


def permanent_dx(gp: DataFrame, hospital: DataFrame, codelist: DataFrame, cfg: Config) -> DataFrame:
    """Earliest diagnosis per patient and permanent condition; general practice wins a tied date.

    Two conditional minima, combined map-side: no sort, and no more than one row per patient, condition
    and task is shuffled.
    """
    recent = F.datediff(F.lit(cfg.end), F.col("obsdate")) <= F.col("read")
    listed = _conditions(gp, codelist, cfg.permanent).where(recent)
    stays = hospital.where(F.col("list_disease_real").isin(*cfg.permanent))
    columns = ("patid", "list_disease_real", "obsdate", "source")
    first = (
        listed.select(*columns)
        .unionByName(stays.select(*columns))
        .groupBy("patid", "list_disease_real")
        .agg(
            F.min(F.when(F.col("source") == SOURCE_GP, F.col("obsdate"))).alias("gp"),
            F.min(F.when(F.col("source") == SOURCE_HOSPITAL, F.col("obsdate"))).alias("hospital"),
        )
    )
    from_gp = F.col("gp").isNotNull() & (F.col("hospital").isNull() | (F.col("gp") <= F.col("hospital")))
    return first.select(
        "patid",
        "list_disease_real",
        F.least("gp", "hospital").alias("diag_date"),
        F.when(from_gp, F.lit(SOURCE_GP)).otherwise(F.lit(SOURCE_HOSPITAL)).alias("source"),
        F.lit(cfg.end).alias("remission_date"),
    )


def resolving_events(gp: DataFrame, hospital: DataFrame, codelist: DataFrame, cfg: Config) -> DataFrame:
    """Dated events of the resolving conditions. General practice durations get a day for leap years.

    Repeats are removed map-side first, which bounds a patient's events by the days of the calendar:
    the windows that follow never meet an unbounded group.
    """
    listed = _conditions(gp, codelist, cfg.resolving).withColumn("disease_duration", (F.col("read") + 1).cast("int"))
    stays = hospital.where(F.col("list_disease_real").isin(*cfg.resolving))
    columns = ("patid", "list_disease_real", "obsdate", "disease_duration", "source")
    return (
        listed.where("patid is not null")
        .select(*columns)
        .unionByName(stays.withColumn("disease_duration", F.col("disease_duration").cast("int")).select(*columns))
        .distinct()
    )


