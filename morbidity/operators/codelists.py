"""Code lists: medical codes, ICD-10 codes and prescribed products, each mapped to conditions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from morbidity.config import LOOK_BACK, PERMANENT_DAYS, Config
from morbidity.functions.nulls import if_known
from morbidity.functions.text import normalise_disease
from morbidity.operators.joins import lookup_join

# fixed values
TYPE_2_TEXT = "Type 2|type 2|type ii|Type ii|Type II|type II|non-insul|Non-insul|non insul|Non insul"
TYPE_2_DISEASE = "Type_2_Diabetes_Mellitus"
ALCOHOL_DISEASE = "Alcohol_Misuse"
ALCOHOL_OTHER = "Other alcohol problems"
ALCOHOL_CATEGORY = "Diagnosis of Alcohol Problems"
LIVER_TEXT = "liver "
CKD = "chronic_kidney_disease"
CKD_TEST = "chronic_kidney_disease_incl_test"
CKD_PROC = "chronic_kidney_disease_incl_test_and_proc"
ICD_RENAMES = {
    "primary_malignancy_lung_and_trachea": "primary_malignancy_lung",
    "primary_malignancy_colorectal_and_anus": "primary_malignancy_bowel",
}


def load_codelist(raw: DataFrame) -> DataFrame:
    """Lower-case the names, drop rows without a code, add the look-back days of the system."""
    out = raw.withColumnsRenamed({c: c.lower() for c in raw.columns})
    for code in ("medcodeid", "prodcodeid"):
        if code in out.columns:
            out = out.where(F.col(code).isNotNull()).withColumn(code, F.col(code).cast("long"))
    if "system" in out.columns:
        days = F.when(F.col("system").isNull(), F.lit(None))
        for system, value in LOOK_BACK.items():
            days = days.when(F.col("system") == system, F.lit(value))
        out = out.withColumn("read", days.otherwise(F.lit(PERMANENT_DAYS)).cast("int"))
    if "disease" in out.columns:
        out = out.withColumn("disease", F.replace("disease", F.lit(" "), F.lit("_")))
    return out


def with_groups(disease_map: DataFrame, cfg: Config) -> DataFrame:
    """Studied conditions, each also listed under its aggregate condition, with the hospital join key."""
    name = F.col("list_disease_real")
    group = F.lit(None).cast("string")
    for member, aggregate in cfg.groups.items():
        group = F.when(name == member, F.lit(aggregate)).otherwise(group)
    both = F.array_compact(F.array(name, group))
    return (
        disease_map.where(name.isin(*cfg.conditions))
        .withColumn("list_disease_real", F.explode(both))
        .withColumn("disease_tomerge", normalise_disease(F.col("Disease"), map_side=True))
    )


def build_codelist(codes: DataFrame, grouped_map: DataFrame) -> DataFrame:
    """Codes with a condition; a code has one row per condition it counts under."""
    names = grouped_map.select(F.col("Disease").alias("disease"), "list_disease_real")
    return lookup_join(codes, names, "disease").select(
        "disease", "medcodeid", "read", "list_disease_real", "descr"
    )


def apply_description_rules(codelist: DataFrame) -> DataFrame:
    """Corrections read from the code's description; a missing description leaves a null condition."""
    name, disease, descr = F.col("list_disease_real"), F.col("disease"), F.col("descr")
    type_2 = (name == "Diabetes excl Type 2") & descr.rlike(TYPE_2_TEXT)
    typed = codelist.withColumns(
        {
            "list_disease_real": if_known(type_2, F.lit("Diabetes Type 2"), name),
            "disease": if_known(type_2, F.lit(TYPE_2_DISEASE), disease),
        }
    )
    liver = (disease == ALCOHOL_DISEASE) & descr.contains(LIVER_TEXT)
    return typed.withColumn("list_disease_real", if_known(liver, F.lit(ALCOHOL_OTHER), name))


def set_durations(codelist: DataFrame, cfg: Config) -> DataFrame:
    """One row per (code, condition) with the final look-back days."""
    name, read = F.col("list_disease_real"), F.col("read")
    alcohol = codelist.withColumn("read", if_known(name == "Alcohol problems", F.lit(365), read))
    first = F.min(F.struct("disease", "descr", "read")).alias("first")
    once = alcohol.groupBy("medcodeid", "list_disease_real").agg(first)
    once = once.select("first.disease", "medcodeid", "first.read", "list_disease_real", "first.descr")
    asthma = once.withColumn("read", if_known(name == "Asthma", F.lit(365), read))
    return asthma.withColumn(
        "read", F.when(name.isin(*cfg.permanent), F.lit(PERMANENT_DAYS)).otherwise(read).cast("int")
    )


def _renamed(test: Callable[[Column], Column], value: str) -> Callable[[Column], Column]:
    return lambda key: if_known(test(key), F.lit(value), key)


def clean_icd(icd: DataFrame, cfg: Config) -> DataFrame:
    """Hospital code rows with a corrected join key; kidney disease also gets its wider definitions."""
    key, code = F.col("disease_tomerge"), F.col("ICD10code")
    base = icd.withColumn("disease_tomerge", normalise_disease(F.col("Disease")))
    base = base.withColumn("disease_tomerge", if_known(key == "end_stage_renal_disease", F.lit(CKD), key))
    base = base.withColumn(
        "disease_tomerge", if_known((key == CKD) & F.col("OPCS4code").isNotNull(), F.lit(CKD_PROC), key)
    )
    alcohol = (F.col("Category") == ALCOHOL_CATEGORY) & F.col("ICD10codeDescr").contains(LIVER_TEXT)

    # One row becomes one to three: itself, and for kidney disease the copies under the two wider
    # definitions. The alcohol correction comes before the last copy is added, so that copy keeps its key.
    corrected = if_known(alcohol, F.lit("alcohol_problems_other"), key)
    test_copy = if_known(alcohol, F.lit("alcohol_problems_other"), F.lit(CKD_TEST))
    keys = F.when(key == CKD, F.array(corrected, test_copy, F.lit(CKD_PROC))).otherwise(F.array(corrected))

    # The rules that follow meet the keys inside the array, as rules over a column would be written out again and again where a join
    # asks for a key that isn't null.
    prefix = F.substring(code, 1, 3)
    localised = F.substring(code, 1, 5 if cfg.fix_icd else 4) == "L94.9"
    rules = [
        (lambda k: prefix == "E11", "type_2_diabetes_mellitus"),
        (lambda k: (k == "diabetes") & (prefix != "E11"), "type_1_diabetes_mellitus"),
        (lambda k: (F.substring(code, 1, 2) == "M3") | localised, "connective_tissue_disorder"),
        *[(F.lit(old).__eq__, new) for old, new in ICD_RENAMES.items()],
    ]
    for test, value in rules:
        keys = F.transform(keys, _renamed(test, value))
    return base.withColumn("disease_tomerge", F.explode(keys))


def expand_icd(df: DataFrame) -> DataFrame:
    """Three-character codes stand for themselves and their ten decimals."""
    code = F.col("ICD10code")
    decimals = [F.concat(code, F.lit(f".{d}")) for d in range(10)]
    codes = F.when(F.length(code) == 3, F.array(code, *decimals)).otherwise(F.array(code))
    return (
        df.where(code.isNotNull())
        .select(F.explode(codes).alias("ICD10code"), "list_disease_real")
        .distinct()
    )


def icd_lookup(
    clean: DataFrame, grouped_map: DataFrame, codelist: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df
) -> DataFrame:
    """ICD-10 code to condition and duration. Conditions without a hospital code keep a null code. The codes are used twice: ``keep`` may write them."""
    names = grouped_map.select("disease_tomerge", "list_disease_real")
    codes = keep(expand_icd(lookup_join(clean, names, "disease_tomerge")), "icd_conditions")
    durations = codelist.select("list_disease_real", F.col("read").alias("disease_duration")).distinct()
    # a right join in two halves, because Spark can neither broadcast nor split the kept side
    coded = lookup_join(codes, durations, "list_disease_real")
    uncoded = durations.join(codes.select("list_disease_real").distinct(), "list_disease_real", "left_anti")
    out = coded.unionByName(uncoded.withColumn("ICD10code", F.lit(None).cast("string")))
    return out.select("ICD10code", "list_disease_real", "disease_duration")


def build_prodcodes(
    drug_lists: DataFrame, gemscript_dmd: DataFrame, products: DataFrame, cfg: Config
) -> DataFrame:
    """Products of the studied drug lists: drug list -> gemscript code -> dm+d code -> product id."""
    listed = drug_lists.where(F.col("cond").isin(*cfg.rx_conditions))
    mapped = listed.join(gemscript_dmd, listed.gemscriptcode == gemscript_dmd.gemscript_drug_code)
    return (
        mapped.join(products, F.col("dmd_code") == F.col("dmdid"))
        .select("cond", F.col("dmd_code").alias("dmd"), F.col("ProdCodeId").cast("long").alias("prodcodeid"))
        .distinct()
    )
