"""From raw tables to the panel and the reports.

Each step takes and returns DataFrames. Event tables are scanned once per step and reduced to patient,
condition and day before the first shuffle by patient; from there to the panel every step is keyed on
the patient.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame

from morbidity.config import (
    PREVALENCE_CRUDE_REPORTS,
    PREVALENCE_STANDARD_REPORTS,
    SCORE_CRUDE_REPORTS,
    SCORE_STANDARD_REPORTS,
    Config,
)
from morbidity.operators import (
    clean,
    cohort,
    demographics,
    diagnosis,
    panel,
    prescriptions,
    reports,
    score,
    spells,
    standardise,
)
from morbidity.operators.joins import restrict_to
from morbidity.sources.writers import by_key, stage


@dataclass(frozen=True)
class Tables:
    """Raw tables and code tables of a run; see ``morbidity.sources.schemas`` for their columns."""

    patient: DataFrame
    practice: DataFrame
    hospital_link: DataFrame
    death_register: DataFrame
    deprivation: DataFrame
    observation: DataFrame
    drug_issue: DataFrame
    inpatient_diagnosis: DataFrame
    outpatient_clinical: DataFrame
    outpatient_appointment: DataFrame
    inpatient_episode: DataFrame
    emergency_attendance: DataFrame
    outpatient_visit: DataFrame
    gp_ethnicity_lookup: DataFrame
    hospital_ethnicity_lookup: DataFrame
    codelist: DataFrame
    icd_lookup: DataFrame
    prodcodes: DataFrame
    procedure: DataFrame | None = None


#: Writes a table under a name and gives it back: ``stage``, ``writers.Addressed`` for tables that a later run finds again, or ``writers.by_key``.
Keep = Callable[[DataFrame, str], DataFrame]


def eligible_patients(t: Tables, cfg: Config) -> DataFrame:
    """Patients under study with death, region and censoring dates."""
    patients = t.patient
    if cfg.remove_duplicate_practices:
        patients = cohort.drop_duplicate_practices(patients, cfg)
    if cfg.remove_linked_duplicates:
        patients = cohort.dedupe_linked(patients, t.hospital_link)
    dated = cohort.with_practice(cohort.with_death_date(patients, t.death_register, cfg), t.practice, cfg)
    return cohort.valid_follow_up(cohort.with_censor_date(dated, cfg))


def coded_events(t: Tables, patients: DataFrame, cfg: Config) -> DataFrame:
    """Cleaned observations with a listed code, of a condition or of an ethnic group. The code filter comes first, for it
    drops most rows."""
    codes = t.codelist.select("medcodeid").union(t.gp_ethnicity_lookup.select("medcodeid"))
    coded = diagnosis.coded_only(t.observation, codes)
    if cfg.clean_observations:
        coded = clean.clean_birth_year(clean.clean_observation_dates(coded, cfg), patients)
    else:
        coded = restrict_to(coded, patients)
    return coded.select("patid", "medcodeid", "obsdate", "obstypeid")


def hospital_events(t: Tables, patients: DataFrame, cfg: Config) -> DataFrame:
    inpatient = t.inpatient_diagnosis
    if cfg.clean_episodes:
        inpatient = clean.fill_date(inpatient, "epistart", "epiend")
    outpatient = diagnosis.outpatient_rows(t.outpatient_clinical, t.outpatient_appointment, t.icd_lookup, cfg)
    return diagnosis.hospital_dx(diagnosis.inpatient_rows(inpatient, t.icd_lookup, cfg), outpatient, patients, cfg)


def ethnicity_records(t: Tables, observations: DataFrame, cfg: Config) -> DataFrame:
    """Ethnic groups from hospital contacts and from cleaned general practice observations."""
    groups = t.hospital_ethnicity_lookup
    hospital = demographics.hospital_ethnicity(t.inpatient_episode, t.emergency_attendance, t.outpatient_visit, groups)
    return hospital.unionByName(demographics.gp_ethnicity(observations, t.gp_ethnicity_lookup, groups, cfg))


def ethnicity(t: Tables, observations: DataFrame, cfg: Config) -> DataFrame:
    """One ethnic group for each patient who has any."""
    return demographics.modal_value(ethnicity_records(t, observations, cfg), "patid", "HES_ethnic_group", "obsdate")


def prescription_spells(t: Tables, observations: DataFrame, patients: DataFrame, cfg: Config) -> DataFrame:
    epilepsy = prescriptions.first_date(observations, t.codelist.where("disease = 'Epilepsy'"), cfg)
    candidates = prescriptions.rx_candidates(t.drug_issue, t.prodcodes, cfg)
    # candidates hold no repeats any more, so the patients can join without skew
    known = candidates.join(patients.select("patid"), "patid", "left_semi")
    flagged = prescriptions.rx_flag(known, cfg)
    kept = prescriptions.exclude_after(flagged, epilepsy, cfg.rx_excluded_after_epilepsy)
    return prescriptions.rx_spells(kept, cfg)


def procedures(t: Tables, cfg: Config) -> DataFrame | None:
    """Hospital procedures; one without a date gets that of its episode."""
    clean_them = t.procedure is not None and cfg.clean_procedures
    return clean.fill_date(t.procedure, "evdate", "epistart") if clean_them else t.procedure


def diagnoses(
    t: Tables, patients: DataFrame, observations: DataFrame, cfg: Config, keep: Keep = stage
) -> tuple[DataFrame, DataFrame]:
    """Permanent diagnoses and resolving spells."""
    hospital = keep(hospital_events(t, patients, cfg), "hospital")
    gp = diagnosis.gp_events(observations, cfg)
    permanent = diagnosis.permanent_dx(gp, hospital, t.codelist, cfg)
    found = spells.resolving_spells(diagnosis.resolving_events(gp, hospital, t.codelist, cfg), cfg)
    if cfg.use_prescriptions:
        found = found.unionByName(prescription_spells(t, observations, patients, cfg))
    if cfg.merge_spells:  # merging drops repeats
        return permanent, spells.merge_sources(spells.merge_close_spells(found, cfg.merge_days))
    return permanent, found.distinct()


def study_panel(t: Tables, cfg: Config, keep: Keep = stage) -> DataFrame:
    """The patient-by-year panel.

    Patients, coded observations and hospital diagnoses each feed several steps, so they are written once
    to the shared folder; all are far smaller than the events they come from.
    """
    return panel_of(t, keep(eligible_patients(t, cfg), "patients"), cfg, keep)


def panel_of(t: Tables, eligible: DataFrame, cfg: Config, keep: Keep = stage) -> DataFrame:
    """The panel of given patients, as ``eligible_patients`` has them."""
    observations = keep(coded_events(t, eligible, cfg), "observations")
    permanent, found = diagnoses(t, eligible, observations, cfg, keep)
    patients = demographics.patient_table(eligible, t.deprivation, ethnicity(t, observations, cfg))
    return panel.assemble_panel(patients, permanent, found, cfg)


def by_patient(t: Tables, n: int) -> tuple[Tables, Keep]:
    """The tables with a patient in buckets by patient, ``n`` at least and two for each core, up to a shuffle's partitions, and the ``Keep`` that stores interim tables alike: with both, no raw or coded event is
    moved by patient. Spark forgets the buckets where sources are united; by then rows are reduced to patient, condition and day. Worth
    its one exchange where several panels are made from one extract."""
    spark = t.patient.sparkSession
    # with more buckets than that Spark may move both sides of a join
    keep = by_key("patid", max(n, min(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    own = {f.name: getattr(t, f.name) for f in fields(t)}
    return Tables(**{k: keep(d, k) if d is not None and "patid" in d.columns else d for k, d in own.items()}), keep


def reported_rows(panel_df: DataFrame, cfg: Config) -> DataFrame:
    standard = standardise.standard_population(panel_df.sparkSession, cfg)
    return standardise.active_rows(score.with_score(panel_df, cfg), standard, cfg)


def score_reports(cells: DataFrame, cfg: Config) -> DataFrame:
    value = ["cam_score_general"]
    crude = reports.weighted_report(cells, value, "actual_pop_wt", SCORE_CRUDE_REPORTS, cfg.strict)
    standard = reports.weighted_report(cells, value, "standard_pop_wt", SCORE_STANDARD_REPORTS, cfg.strict)
    return crude.unionByName(standard)


def prevalence_reports(cells: DataFrame, cfg: Config) -> DataFrame:
    values = [f"prev_{c}" for c in cfg.reported_columns]
    crude = reports.weighted_report(cells, values, "actual_pop_wt", PREVALENCE_CRUDE_REPORTS, cfg.strict)
    standard = reports.weighted_report(cells, values, "standard_pop_wt", PREVALENCE_STANDARD_REPORTS, cfg.strict)
    return crude.unionByName(standard)


def study_reports(panel_df: DataFrame, cfg: Config, keep: Keep = stage) -> dict[str, DataFrame]:
    """Both report families of a panel, which should be a written one."""
    return merged_reports([keep(standardise.cell_states(reported_rows(panel_df, cfg), cfg), "cells")], cfg)


def merged_reports(states: list[DataFrame], cfg: Config) -> dict[str, DataFrame]:
    """Both report families of panels without a patient in common, from their cell states (``standardise.cell_states``)."""
    cells = standardise.cells_of(standardise.merged(states) if len(states) > 1 else states[0], cfg)
    return {"score": score_reports(cells, cfg), "prevalence": prevalence_reports(cells, cfg)}
