"""Test tables in the role of the clinical tables: one SQL text, read by Spark and by the checking engine."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from morbidity.config import CONDITION_GROUPS, PERMANENT_DAYS, RESOLVING, Config
from morbidity.plans.study import Tables
from morbidity.session import tuned

SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}

# The test orders run from 1995 to 2001, so the study is placed there.
CFG = Config(
    start=date(1995, 4, 1),
    end=date(2001, 3, 31),
    first_year=1995,
    last_year=2000,
    gp_death_after=date(1998, 10, 31),
    report_first_year=1996,
    report_last_year=1999,
    standard_first_year=1996,
    standard_last_year=2000,
    duplicate_practices=(7, 19),
    region_overrides={5: 2, 9: 2},
)


def values(names: str, rows: list[tuple]) -> str:
    def literal(x):
        return "null" if x is None else f"'{x}'" if isinstance(x, str) else str(x)

    body = ", ".join("(" + ", ".join(literal(x) for x in r) + ")" for r in rows)
    typed = ", ".join(f"cast({n} as bigint) as {n}" if n == "medcodeid" else n for n in names.split(", "))
    return f"select {typed} from (values {body}) as t({names})"


def days(condition: str) -> int:
    if "cancer" in condition:
        return 1826
    return 365 if condition in RESOLVING else PERMANENT_DAYS


def _with_group(condition: str) -> list[str]:
    return [condition] + ([CONDITION_GROUPS[condition]] if condition in CONDITION_GROUPS else [])


BLOCKS = ("Asthma", "Anxiety", "Depression", "Hypertension", "Epilepsy", "Breast cancer", "Lung cancer", "COPD")
CODES = [
    (name.replace(" ", "_"), 4 * i + k, days(name), c, f"{name} {k}")
    for i, name in enumerate(BLOCKS)
    for k in range(4)
    for c in _with_group(name)
]
ICD = {
    "E10": "Diabetes excl Type 2", "E11": "Diabetes Type 2", "F10": "Alcohol problems", "F12": "Depression",
    "F13": "Anxiety", "I10": "Hypertension", "I11.0": "Heart failure", "J10": "Asthma", "J12": "Lung cancer",
    "J13.4": "COPD",
}
ICD_ROWS = [
    (code, c, days(name))
    for short, name in ICD.items()
    for code in ([short] + [f"{short}.{d}" for d in range(10)] if len(short) == 3 else [short])
    for c in _with_group(name)
] + [(None, "Epilepsy", PERMANENT_DAYS)]
ETHNIC_CODES = [
    (32, "British", "White British", "White", "White"), (33, "Irish", "White Irish", "White", "White"),
    (34, "Indian", "Indian", "South Asian", "Asian"), (35, "Pakistani", "Pakistani", "South Asian", "Asian"),
    (36, "Caribbean", "Caribbean", "Black", "Black"), (37, "African", "African", "Black", "Black"),
]
ETHNIC_GROUPS = [
    ("White", "White"), ("Asian", "South Asian"), ("Bangladeshi", "South Asian"), ("Black", "Black"),
    ("Unknown", "Unknown"),
]
DISEASES = [
    ("Asthma", "Asthma"), ("Anxiety disorders", "Anxiety"), ("Depression", "Depression"),
    ("Type 1 Diabetes Mellitus", "Diabetes excl Type 2"), ("Type 2 Diabetes Mellitus", "Diabetes Type 2"),
    ("Alcohol Misuse", "Alcohol problems"), ("Primary Malignancy-Lung", "Lung cancer"),
    ("Primary Malignancy Bowel", "Bowel cancer"), ("Chronic Kidney Disease", "Chronic kidney disease"),
    ("Connective Tissue Disorder", "Connective tissue disorder"), ("Atrial fibrillation", "Atrial fibrilation"),
    ("Back Pain", "Back pain"),
]
_CASE = " ".join(f"when {i} then '{d}'" for i, (d, _) in enumerate(DISEASES))
_ICD_DISEASE = " ".join(
    f"when {i} then '{d}'"
    for i, d in enumerate((
        "Asthma", "Diabetes", "Chronic Kidney Disease", "End stage renal disease", "Alcohol Problems",
        "Primary Malignancy Lung and Trachea", "Primary Malignancy Colorectal and Anus", "Back Pain",
    ))
)

# {name} stands for a test table.
SQL = {
    "patient": """
select c_custkey as patid, c_nationkey as pracid,
  cast(1900 + (c_custkey*37)%100 as int) as yob,
  cast(1 + c_custkey%2 as int) as gender,
  date '1993-01-01' + cast((c_custkey*11)%2000 as int) as regstartdate,
  case when c_custkey%4=0 then date '1997-01-01' + cast((c_custkey*17)%1500 as int) end as regenddate,
  case when c_custkey%45=1 then date '1998-06-01' + cast((c_custkey*7)%900 as int) end as cprd_ddate
from {customer}""",
    "hospital_link": """
select case when c_custkey%10<7 then c_custkey else -c_custkey end as patid,
  cast(floor(c_custkey/3) as bigint) as gen_hesid
from {customer}""",
    "death_register": """
select case when c_custkey%9=0 then c_custkey else -c_custkey end as patid,
  date '1996-01-01' + cast((c_custkey*13)%1900 as int) as dod, cast(1 + c_custkey%3 as int) as match_rank
from {customer}
union all
select case when c_custkey%27=0 then c_custkey else -c_custkey end as patid,
  date '1995-06-01' + cast((c_custkey*5)%1900 as int) as dod, cast(1 + c_custkey%2 as int) as match_rank
from {customer}""",
    "practice": """
select n_nationkey as pracid, n_regionkey as region,
  date '2001-06-30' - cast(n_nationkey*30 as int) as lcd
from {nation}""",
    "deprivation": """
select case when c_custkey%101=5 then -c_custkey else c_custkey end as patid,
  case when c_custkey%53=0 then null
       else cast(1 + cast(floor(c_custkey/2) as bigint)%10 as int) end as imd2015_decile
from {customer}""",
    "observation": """
select o_custkey as patid, l_orderkey*10 + l_linenumber as obsid, l_partkey%40 as medcodeid,
  cast(l_partkey%7 as int) as obstypeid,
  case when l_orderkey%89=0 then null
       when l_orderkey%97=0 then date '1850-01-01'
       else cast(l_shipdate as date) end as obsdate,
  case when l_orderkey%194=0 then null
       else cast(l_shipdate as date) + cast(l_linenumber as int) end as enterdate
from {lineitem} join {orders} on l_orderkey=o_orderkey""",
    "drug_issue": """
select o_custkey as patid, l_partkey%40 as prodcodeid, cast(l_shipdate as date) as issuedate
from {lineitem} join {orders} on l_orderkey=o_orderkey""",
    "prodcodes": """
select cast(case when p_partkey%5=4 then -p_partkey else p_partkey end as bigint) as prodcodeid,
  case cast(floor(p_partkey/8) as bigint)%3 when 0 then 'CON150' when 1 then 'PNC166' else 'PNC167' end as cond
from {part}""",
    "inpatient": """
select o_custkey as patid, o_orderkey as epikey,
  case when o_orderkey%31=0 then null else cast(o_orderdate as date) end as epistart,
  cast(o_orderdate as date) + cast(o_orderkey%5 as int) as epiend,
  concat(substr('EFIJ', cast(1 + o_orderkey%4 as int), 1), cast(10 + o_orderkey%5 as string),
    case when o_orderkey%3=0 then '' else concat('.', cast(cast(floor(o_orderkey/20) as bigint)%10 as string)) end) as icd
from {orders}""",
    "procedures": """
select o_custkey as patid, o_orderkey as epikey,
  case when o_orderkey%9=0 then null else cast(o_orderdate as date) + cast(o_orderkey%3 as int) end as evdate,
  cast(o_orderdate as date) as epistart
from {orders}""",
    "op_clinical": """
select o_custkey as patid, case when o_orderkey%3=1 then -o_orderkey else o_orderkey end as attendkey,
  concat(substr('EFIJ', cast(1 + o_orderkey%4 as int), 1), cast(10 + o_orderkey%5 as string),
    cast(cast(floor(o_orderkey/20) as bigint)%10 as string)) as diag_01,
  case when o_orderkey%2=0 then concat(substr('FIJE', cast(1 + o_orderkey%4 as int), 1),
    cast(10 + o_orderkey%3 as string), 'X') else '' end as diag_02,
  case when o_orderkey%6=0 then 'I10' end as diag_03
from {orders}""",
    "op_appointment": """
select o_custkey as patid, case when o_orderkey%7=2 then o_orderkey + 1000000000000 else o_orderkey end as attendkey,
  cast(o_orderdate as date) as apptdate
from {orders}""",
    "eth_episodes": """
select o_custkey as patid, cast(o_orderdate as date) as admidate,
  case when o_orderkey%13=0 or o_custkey%6=0 or o_orderkey%3<>0 then 'Unknown' when o_orderkey%4=0 then 'White'
       when o_orderkey%4=1 then 'Asian' else 'Black' end as ethnos
from {orders}""",
    "eth_attendances": """
select o_custkey as patid, cast(o_orderdate as date) + 1 as arrivaldate,
  case when o_custkey%6=0 or o_orderkey%3<>1 then 'Unknown' when o_orderkey%4=0 then 'White'
       when o_orderkey%4=1 then 'Bangladeshi' else 'Not in lookup' end as ethnos
from {orders}""",
    "eth_outpatients": """
select o_custkey as patid, case when o_orderkey%17<>0 then cast(o_orderdate as date) end as apptdate,
  case when o_custkey%6=0 or o_orderkey%3<>2 then 'Unknown' when o_orderkey%4=1 then 'Asian'
       when o_orderkey%4=2 then 'White' else 'Black' end as ethnos
from {orders}""",
    "codelist": values("disease, medcodeid, read, list_disease_real, descr", CODES),
    "icd_codes": values("ICD10code, list_disease_real, disease_duration", ICD_ROWS),
    "ethnic_codes": values("medcodeid, Term, Group1, Group2, Group3", ETHNIC_CODES),
    "ethnic_groups": values("HES_ethnic_group, HES_category", ETHNIC_GROUPS),
    "disease_map": values("Disease, list_disease_real", DISEASES),
    "code_file": f"""
select case cast(floor(p_partkey/2) as bigint)%{len(DISEASES)} {_CASE} end as Disease,
  case when p_partkey%41=0 then null else cast(floor(p_partkey/2) as bigint) end as MedCodeId,
  case when p_partkey%29=0 then null when p_partkey%5=0 then concat(p_name, ' type 2')
       when p_partkey%7=0 then concat(p_name, ' liver disease') else p_name end as Descr,
  case cast(floor(p_partkey/2) as bigint)%{len(DISEASES)} when 6 then 'Cancers' when 7 then 'Cancers'
    when 1 then 'Mental Health Disorders' when 2 then 'Mental Health Disorders'
    when 10 then null else 'Other' end as System
from {{part}}""",
    "icd_file": f"""
select case p_partkey%8 {_ICD_DISEASE} end as Disease,
  case when p_partkey%8=4 then 'Diagnosis of Alcohol Problems' when p_partkey%11=0 then null
       else 'Other category' end as Category,
  case when p_partkey%37=0 then null else concat(substr('EMLIJ', cast(1 + p_partkey%5 as int), 1),
    cast(10 + cast(floor(p_partkey/8) as bigint)%27 as string),
    case when p_partkey%3=0 then '' else concat('.', cast(p_partkey%10 as string)) end) end as ICD10code,
  case when p_partkey%23=0 then null when p_partkey%3=0 then concat('of liver ', p_name) else p_name end as ICD10codeDescr,
  case when p_partkey%16=2 then 'M01.2' end as OPCS4code
from {{part}}""",
    "drug_list": """
select case p_partkey%4 when 0 then 'CON150' when 1 then 'PNC166' when 2 then 'PNC167' else 'ASM123' end as cond,
  concat('g', cast(cast(floor(p_partkey/2) as bigint) as string)) as gemscriptcode
from {part}""",
    "gemscript_map": """
select concat(case when p_partkey%3=0 then 'x' else 'g' end, cast(p_partkey as string)) as gemscript_drug_code,
  p_partkey*7 as dmd_code
from {part}""",
    "products": """
select cast(floor(p_partkey/2) as bigint)*7 * case when p_partkey%5=1 then -1 else 1 end as dmdid,
  p_partkey + 100000 as ProdCodeId
from {part}""",
    "names": """
select p_partkey, concat(p_type, case when p_partkey%3=0 then '-NOS ' when p_partkey%3=1 then ' Alcohol Misuse '
  else ' other or not specified-' end, p_name) as name
from {part}""",
}


class Fixture:
    """Adapters over one folder of test tables, each read when first used."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: Config = CFG):
        self.spark, self.sf_dir, self.cfg = tuned(spark), sf_dir, cfg
        self._base: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._base:
            path = f"{self.sf_dir}/{name}.parquet"
            self._base[name] = self.spark.read.schema(SCHEMAS[name]).parquet(path)
        return self._base[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SQL:
            raise AttributeError(name)
        used = {b: self.base(b) for b in SCHEMAS if "{" + b + "}" in SQL[name]}
        df = self.spark.sql(SQL[name], **used) if used else self.spark.sql(SQL[name])
        setattr(self, name, df)
        return df

    @cached_property
    def tables(self) -> Tables:
        return Tables(
            patient=self.patient,
            practice=self.practice,
            hospital_link=self.hospital_link,
            death_register=self.death_register,
            deprivation=self.deprivation,
            observation=self.observation,
            drug_issue=self.drug_issue,
            inpatient_diagnosis=self.inpatient,
            outpatient_clinical=self.op_clinical,
            outpatient_appointment=self.op_appointment,
            inpatient_episode=self.eth_episodes,
            emergency_attendance=self.eth_attendances,
            outpatient_visit=self.eth_outpatients,
            gp_ethnicity_lookup=self.ethnic_codes,
            hospital_ethnicity_lookup=self.ethnic_groups,
            codelist=self.codelist,
            icd_lookup=self.icd_codes,
            prodcodes=self.prodcodes,
        )
