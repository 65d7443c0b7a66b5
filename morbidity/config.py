"""Study configuration: fixed values, dates and on/off rules, in one immutable object."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import date

# ---------------------------------------------------------------------------
# Fixed values. They decide the results, so they are stated in full here and
# nowhere else.
# ---------------------------------------------------------------------------

CONDITIONS = (
    "Alcohol problems", "All cancers", "Anxiety", "Asthma", "Atrial fibrillation", "Breast cancer",
    "Lung cancer", "Prostate cancer", "Bowel cancer", "Other cancer", "Chronic kidney disease",
    "Chronic liver disease", "Connective tissue Cam", "Connective tissue disorder", "COPD",
    "Coronary heart disease", "Dementia", "Depression", "Depression_anxiety", "Diabetes",
    "Diabetes excl Type 2", "Diabetes Type 2", "Epilepsy", "Hearing loss", "Heart failure",
    "Hypertension", "IBS", "Psychosis", "Rheumatoid arthritis", "Stroke", "TIA", "Stroke_TIA",
    "Obesity", "Constipation", "Pain",
)

RESOLVING_NON_CANCER = ("Alcohol problems", "Anxiety", "Asthma", "Depression", "Depression_anxiety")
SINGLE_CANCERS = ("Breast cancer", "Lung cancer", "Prostate cancer", "Bowel cancer", "Other cancer")
ALL_CANCERS = "All cancers"
RESOLVING = RESOLVING_NON_CANCER + (ALL_CANCERS,) + SINGLE_CANCERS + ("Constipation", "Pain")

# condition -> the aggregate condition it is also counted under
CONDITION_GROUPS = {
    "Breast cancer": "All cancers",
    "Bowel cancer": "All cancers",
    "Lung cancer": "All cancers",
    "Other cancer": "All cancers",
    "Prostate cancer": "All cancers",
    "Anxiety": "Depression_anxiety",
    "Depression": "Depression_anxiety",
    "Diabetes excl Type 2": "Diabetes",
    "Diabetes Type 2": "Diabetes",
    "Stroke": "Stroke_TIA",
    "TIA": "Stroke_TIA",
    "Connective tissue disorder": "Connective tissue Cam",
    "Rheumatoid arthritis": "Connective tissue Cam",
}

DUPLICATE_PRACTICES = (
    20023, 20084, 20094, 20095, 20107, 20123, 20155, 20175, 20182, 20296, 20303, 20331, 20336, 20428, 20447,
    20472, 20545, 20775, 20776, 20785, 20903, 20988, 21097, 21119, 21236, 21326, 21339, 21349, 21406,
)
REGION_OVERRIDES = {20538: 2, 21258: 2}

# person-level score weight of each condition
SCORE_WEIGHTS = {
    "depression_anxiety": 0.5, "hypertension": 0.08, "hearing_loss": 0.09, "ibs": 0.21, "asthma": 0.19,
    "diabetes": 0.75, "coronary_heart_disease": 0.49, "atrial_fibrillation": 1.34, "stroke_tia": 0.8,
    "copd": 1.46, "connective_tissue_cam": 0.43, "all_cancers": 1.53, "alcohol_problems": 0.65,
    "heart_failure": 1.18, "dementia": 2.5, "psychosis": 0.64, "epilepsy": 0.92, "pain": 0.92,
    "constipation": 1.12,
}
# shares that an aggregate condition of the score already covers
SCORE_COMPONENTS = (
    "diabetes_excl_type_2", "anxiety", "depression", "stroke", "tia", "connective_tissue_disorder",
    "rheumatoid_arthritis",
)
# shares left out of the published tables
UNREPORTED = ("chronic_kidney_disease", "obesity", "chronic_liver_disease")

AGE_BREAKS = (0, 1) + tuple(range(5, 100, 5))
AGE_LABELS = ("0-1", "1-4") + tuple(f"{a}-{a + 4}" for a in range(5, 100, 5))
# European standard population 2013, one weight per age band, 100,000 in all
STANDARD_WEIGHTS = (
    1000, 4000, 5500, 5500, 5500, 6000, 6000, 6500, 7000, 7000, 7000, 7000, 6500, 6000, 5500, 5000, 4000, 2500,
    1500, 800, 200,
)
DECILE_LABELS = ("1 most deprived",) + tuple(str(d) for d in range(2, 10)) + ("10 least deprived",)

# look-back, in days, by codelist system
LOOK_BACK = {"Cancers": 1826, "Mental Health Disorders": 365}
PERMANENT_DAYS = 9999999
PERMANENT_FROM = 999999

SOURCE_GP = "CPRD"
SOURCE_HOSPITAL = "HES"
SOURCE_BOTH = "Both HES and CPRD"

# report name -> grouping keys beside the year
SCORE_CRUDE_REPORTS = {
    "cms_nonstan_year": (),
    "cms_nonstan_sex_year": ("gender",),
    "cms_nonstan_age_year": ("agecat",),
    "cms_nonstan_imd_year": ("imd_deciles", "imd2015_decile"),
    "cms_nonstan_age_sex_year": ("agecat", "gender"),
    "cms_nonstan_age_sex_imd_year": ("agecat", "gender", "imd_deciles", "imd2015_decile"),
}
SCORE_STANDARD_REPORTS = {
    "cms_stan_year": (),
    "cms_stan_sex_year": ("gender",),
    "cms_stan_age_sex_year": ("agecat", "gender"),
    "cms_stan_age_year": ("agecat",),
    "cms_stan_imd_year": ("imd_deciles", "imd2015_decile"),
}
PREVALENCE_CRUDE_REPORTS = {
    "prev_cond_nonstan_year": (),
    "prev_cond_nonstan_sex_year": ("gender",),
    "prev_cond_nonstan_age_year": ("agecat",),
    "prev_cond_nonstan_imd_year": ("imd_deciles", "imd2015_decile"),
    "prev_cond_nonstan_age_sex_year": ("agecat", "gender"),
    "prev_cond_age_sex_imd_year": ("agecat", "gender", "imd_deciles", "imd2015_decile"),
}
PREVALENCE_STANDARD_REPORTS = {
    "prev_cond_stan_year": (),
    "prev_cond_stan_age_sex_year": ("agecat", "gender"),
    "prev_cond_stan_sex_year": ("gender",),
    "prev_cond_stan_age_year": ("agecat",),
    "prev_cond_stan_imd_year": ("imd_deciles", "imd2015_decile"),
}
# names of drug list files, and the part of them that names the list
DRUG_LIST_GLOB = "*_PC_V1-1_*"
DRUG_LIST_TAG = r"CPRDCAM_(.{6})"
# ------------------------------------------------------------- end of fixed values


def column_name(condition: str) -> str:
    """Column stem of a condition: "Heart failure" -> "heart_failure"; what can't stand in a name becomes "_" too."""
    return re.sub(r"\W", "_", condition.lower())


@dataclass(frozen=True)
class Config:
    """Everything a run may change. The defaults are the published study."""

    start: date = date(2007, 4, 1)
    end: date = date(2021, 3, 31)
    first_year: int = 2007
    last_year: int = 2020

    plausible_from: date = date(1900, 1, 1)
    plausible_to: date = date(2023, 1, 1)
    gp_death_after: date = date(2019, 10, 31)
    family_history: int = 4

    report_first_year: int = 2008
    report_last_year: int = 2019
    standard_first_year: int = 2008
    standard_last_year: int = 2020
    age_from: int = 30
    age_to: int = 99
    genders: tuple[int, ...] = (2, 1)

    cancer_days: int = 3653
    merge_days: int = 365
    rx_min_count: int = 4
    rx_days: int = 365
    rx_conditions: tuple[str, ...] = ("CON150", "PNC166", "PNC167")
    rx_excluded_after_epilepsy: str = "PNC167"

    conditions: tuple[str, ...] = CONDITIONS
    resolving: tuple[str, ...] = RESOLVING
    resolving_non_cancer: tuple[str, ...] = RESOLVING_NON_CANCER
    single_cancers: tuple[str, ...] = SINGLE_CANCERS
    groups: dict[str, str] = field(default_factory=lambda: dict(CONDITION_GROUPS), hash=False)
    duplicate_practices: tuple[int, ...] = DUPLICATE_PRACTICES
    region_overrides: dict[int, int] = field(default_factory=lambda: dict(REGION_OVERRIDES), hash=False)
    score_weights: dict[str, float] = field(default_factory=lambda: dict(SCORE_WEIGHTS), hash=False)

    # rules that a run may switch off
    remove_duplicate_practices: bool = True
    remove_linked_duplicates: bool = True
    clean_observations: bool = True
    clean_episodes: bool = True
    clean_procedures: bool = True
    use_prescriptions: bool = True
    merge_spells: bool = True
    keep_death: bool = True
    fix_icd: bool = False
    strict: bool = False

    @property
    def permanent(self) -> tuple[str, ...]:
        return tuple(c for c in self.conditions if c not in self.resolving)

    @property
    def condition_columns(self) -> tuple[str, ...]:
        return tuple(column_name(c) for c in self.conditions)

    @property
    def reported_columns(self) -> tuple[str, ...]:
        """Condition columns that reach the prevalence tables."""
        left_out = SCORE_COMPONENTS + UNREPORTED
        return tuple(c for c in self.condition_columns if c not in left_out)
