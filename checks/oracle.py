"""SQL that restates each operator from its definition, for the checking engine.

Written row by row from the semantics, in the shape of the definition rather than of the Spark plans: year
cross joins, correlated look-ups and running sums are fine here. ``{name}`` is a test table; every other
table name is an adapter or one of the steps below.
"""

from __future__ import annotations

import re

from checks.adapters import CFG, SQL
from morbidity.config import (
    AGE_BREAKS,
    AGE_LABELS,
    DECILE_LABELS,
    PREVALENCE_CRUDE_REPORTS,
    PREVALENCE_STANDARD_REPORTS,
    SCORE_COMPONENTS,
    SCORE_CRUDE_REPORTS,
    SCORE_STANDARD_REPORTS,
    SCORE_WEIGHTS,
    STANDARD_WEIGHTS,
    column_name,
)


def names(items) -> str:
    return ", ".join(f"'{i}'" for i in items)


END = f"date '{CFG.end}'"
PERMANENT, RESOLVING = names(CFG.permanent), names(CFG.resolving)

STEPS: dict[str, str] = {}

# ------------------------------------------------------------------ cohort
STEPS["o_kept"] = f"select * from patient where pracid not in ({', '.join(map(str, CFG.duplicate_practices))})"
STEPS["o_deduped"] = """
select patid, pracid, yob, gender, regstartdate, regenddate, cprd_ddate from (
  select p.*, l.gen_hesid, row_number() over (partition by l.gen_hesid
    order by regstartdate desc nulls last, regenddate desc nulls last, p.patid desc) as n
  from o_kept p left join hospital_link l on l.patid = p.patid)
where gen_hesid is null or n = 1"""
STEPS["o_death"] = """
select p.*, case when r.dod is not null then r.dod
  when p.cprd_ddate > date '1998-10-31' then p.cprd_ddate end as death_date
from o_deduped p left join (select * from (select *, row_number() over (partition by patid
  order by match_rank nulls last, dod nulls last) as n from death_register) where n = 1) r on r.patid = p.patid"""
STEPS["o_pat"] = f"""
select * from (
  select d.patid, d.pracid, d.yob, d.gender, d.regstartdate, coalesce(d.regenddate, d.death_date) as regenddate,
    d.cprd_ddate, d.death_date, cast(case when d.pracid in (5, 9) then 2 else r.region end as int) as region, r.lcd,
    least(coalesce(d.regenddate, d.death_date), d.death_date, r.lcd, {END}) as censor_date
  from o_death d left join practice r on r.pracid = d.pracid)
where censor_date > regstartdate"""

# ------------------------------------------------------------------ cleaning
_PLAUSIBLE = "between date '1900-01-01' and date '2023-01-01'"
STEPS["o_clean1"] = f"""
select * from (
  select patid, obsid, medcodeid, obstypeid, enterdate,
    list_filter([coalesce(obsdate, enterdate), enterdate], lambda d: d {_PLAUSIBLE})[1] as obsdate
  from observation)
where obsdate is not null"""
STEPS["o_clean2"] = """
select o.patid, obsid, medcodeid, obstypeid, enterdate, p.yob,
  case when year(obsdate) < p.yob then enterdate else obsdate end as obsdate
from o_clean1 o join o_pat p on p.patid = o.patid
where p.yob is not null and (year(obsdate) >= p.yob or year(enterdate) >= p.yob)"""
STEPS["o_op"] = """
select c.patid, c.attendkey, diag_01, diag_02, diag_03, apptdate
from op_clinical c join op_appointment a on a.patid = c.patid and a.attendkey = c.attendkey"""

# ------------------------------------------------------------------ demographics
STEPS["o_eth_hospital"] = """
select distinct u.patid, u.obsdate, u.g as HES_ethnic_group, k.HES_category, 'HES' as source
from (select patid, admidate as obsdate, ethnos as g from eth_episodes
      union all select patid, arrivaldate, ethnos from eth_attendances
      union all select patid, apptdate, ethnos from eth_outpatients) u
join ethnic_groups k on k.HES_ethnic_group = u.g
where u.g <> 'Unknown'"""


def _eth_gp(obs: str) -> str:
    return f"""
select c.patid, c.obsdate, g.HES_ethnic_group, g.HES_category, 'CPRD' as source
from (select distinct o.patid, o.obsdate, e.Group2 from {obs} o
      join ethnic_codes e on e.medcodeid = o.medcodeid where o.obstypeid <> 4) c
join ethnic_groups g on g.HES_category = c.Group2"""


STEPS["o_eth_gp"] = _eth_gp("o_clean2")
STEPS["o_eth"] = "select * from o_eth_hospital union all select * from o_eth_gp"
STEPS["o_modal"] = """
select patid, HES_ethnic_group from (
  select *, count(*) over (partition by patid) as ties,
    row_number() over (partition by patid order by latest desc nulls last, HES_ethnic_group) as place
  from (select *, max(n) over (partition by patid) as top from (
    select patid, HES_ethnic_group, count(*) as n,
      case when count(*) = count(obsdate) then max(obsdate) end as latest
    from o_eth group by patid, HES_ethnic_group)) where n = top)
where place = 1 and (ties = 1 or latest is not null)"""
STEPS["o_patient_table"] = """
select p.*, d.imd2015_decile, m.HES_ethnic_group as ethnicity
from o_pat p join deprivation d on d.patid = p.patid left join o_modal m on m.patid = p.patid"""

# ------------------------------------------------------------------ diagnoses
_REMISSION = (
    f"case when k.disease_duration < 999999 then h.obsdate + k.disease_duration else {END} end as remission_date"
)
STEPS["o_dx_in"] = f"""
select distinct h.patid, h.obsdate, k.list_disease_real, k.disease_duration, 'HES' as source, {_REMISSION}
from (select patid, case when epistart is null then epiend else epistart end as obsdate, icd from inpatient) h
join icd_codes k on k.ICD10code = h.icd"""
STEPS["o_op_codes"] = """
select patid, apptdate as obsdate, regexp_replace(concat(substr(s, 1, 3), '.', substr(s, 4, 2)), '.X', '.0', 'g') as ICD10code
from (select patid, apptdate, regexp_replace(icd, '[^[:alnum:]]', '', 'g') as s
  from (select patid, apptdate, diag_01 as icd from o_op union all select patid, apptdate, diag_02 from o_op
        union all select patid, apptdate, diag_03 from o_op) where icd is not null and icd <> '')"""
STEPS["o_dx_out"] = f"""
select distinct h.patid, h.obsdate, k.list_disease_real, k.disease_duration, 'HES' as source, {_REMISSION}
from o_op_codes h join icd_codes k on k.ICD10code = h.ICD10code"""
STEPS["o_hospital"] = f"""
select * from (select * from o_dx_in union select * from o_dx_out)
where obsdate <= {END} and patid in (select patid from o_pat)"""
STEPS["o_gp"] = f"""
select distinct patid, medcodeid, obsdate from o_clean2
where medcodeid in (select medcodeid from codelist) and obstypeid <> 4 and obsdate <= {END}"""
STEPS["o_permanent"] = f"""
select patid, list_disease_real, obsdate as diag_date, source, {END} as remission_date from (
  select *, row_number() over (partition by patid, list_disease_real order by obsdate, source) as n from (
    select g.patid, c.list_disease_real, g.obsdate, 'CPRD' as source
    from o_gp g join codelist c on c.medcodeid = g.medcodeid
    where c.list_disease_real in ({PERMANENT}) and {END} - g.obsdate <= c.read
    union all select patid, list_disease_real, obsdate, source from o_hospital
    where list_disease_real in ({PERMANENT})))
where n = 1"""
STEPS["o_events"] = f"""
select distinct * from (
  select g.patid, c.list_disease_real, g.obsdate, c.read + 1 as disease_duration, 'CPRD' as source
  from o_gp g join codelist c on c.medcodeid = g.medcodeid where c.list_disease_real in ({RESOLVING})
  union all select patid, list_disease_real, obsdate, disease_duration, source from o_hospital
  where list_disease_real in ({RESOLVING}))"""
STEPS["o_lagged"] = """
select *, lag(obsdate) over w as before, row_number() over w as n from o_events
window w as (partition by patid, list_disease_real order by obsdate, source, disease_duration)"""

# ------------------------------------------------------------------ spells
STEPS["o_runs"] = f"""
select *, sum(case when n = 1 or obsdate - before > disease_duration then 1 else 0 end)
  over (partition by patid, list_disease_real order by n) as spell
from o_lagged where list_disease_real in ({names(CFG.resolving_non_cancer)})"""
STEPS["o_noncancer"] = """
select patid, list_disease_real, min(obsdate) as diag_date, max(obsdate) + arg_min(disease_duration, n) as remission_date,
  arg_min(disease_duration, n) as disease_duration, arg_min(source, n) as source
from o_runs group by patid, list_disease_real, spell"""
STEPS["o_cancer"] = f"""
select patid, list_disease_real, obsdate as diag_date, obsdate + 3653 as remission_date, disease_duration, source
from o_lagged where n = 1 and list_disease_real in ({names(CFG.single_cancers)})"""
STEPS["o_all_cancer"] = """
select patid, 'All cancers' as list_disease_real, min(diag_date) as diag_date, max(diag_date) + 3653 as remission_date,
  arg_min(disease_duration, list_disease_real) as disease_duration, arg_min(source, list_disease_real) as source
from o_cancer group by patid"""
STEPS["o_resolving"] = """
select * from o_noncancer union all select * from o_cancer union all select * from o_all_cancer"""

# ------------------------------------------------------------------ prescriptions
STEPS["o_epilepsy"] = f"""
select patid, min(obsdate) as epi_diag_date from o_clean2
where medcodeid in (select medcodeid from codelist where disease = 'Epilepsy') and obstypeid <> 4 and obsdate <= {END}
group by patid"""
STEPS["o_issues"] = f"""
select d.patid, k.cond, d.issuedate, d.prodcodeid from drug_issue d join prodcodes k on k.prodcodeid = d.prodcodeid
where d.issuedate <= {END} and d.patid in (select patid from o_pat)"""
STEPS["o_candidates"] = """
select distinct i.patid, i.cond, i.issuedate, i.prodcodeid from o_issues i
join (select patid, cond from o_issues group by patid, cond having count(*) >= 4) e
  on e.patid = i.patid and e.cond = i.cond"""
STEPS["o_flagged"] = """
select *, case when third is not null and third - issuedate <= 365 then 1 else 0 end as flag
from (select *, lead(issuedate, 3) over (partition by patid, cond order by issuedate, prodcodeid) as third
      from o_candidates)"""
STEPS["o_rx_kept"] = """
select f.patid, f.cond, f.issuedate, f.prodcodeid, f.flag,
  case when f.cond = 'CON150' then 'Constipation' else 'Pain' end as list_disease_real
from o_flagged f left join o_epilepsy e on e.patid = f.patid
where not (f.cond = 'PNC167' and e.epi_diag_date is not null and f.issuedate >= e.epi_diag_date)"""
STEPS["o_rx"] = """
select patid, list_disease_real, min(issuedate) as diag_date, max(issuedate) + 365 as remission_date,
  365 as disease_duration, 'CPRD' as source
from (select *, sum(turn) over (partition by patid, list_disease_real order by issuedate, cond, prodcodeid) as run
  from (select *, case when flag <> coalesce(lag(flag) over (partition by patid, list_disease_real
          order by issuedate, cond, prodcodeid), 0) then 1 else 0 end as turn from o_rx_kept))
where flag = 1 group by patid, list_disease_real, run"""

# ------------------------------------------------------------------ merged spells
STEPS["o_found"] = "select distinct * from (select * from o_resolving union all select * from o_rx)"
STEPS["o_close"] = """
select *, sum(case when before is null or diag_date - before >= 365 then 1 else 0 end)
  over (partition by patid, list_disease_real order by diag_date, remission_date, source) as spell
from (select *, lag(remission_date) over (partition by patid, list_disease_real
        order by diag_date, remission_date, source) as before from o_found)"""
STEPS["o_close_rows"] = """
select distinct c.patid, c.list_disease_real, g.diag_date, g.remission_date, c.source
from o_close c join (select patid, list_disease_real, spell, min(diag_date) as diag_date,
    max(remission_date) as remission_date from o_close group by patid, list_disease_real, spell) g
  on g.patid = c.patid and g.list_disease_real = c.list_disease_real and g.spell = c.spell"""
STEPS["o_spells"] = """
select patid, list_disease_real, diag_date, remission_date,
  case count(*) when 1 then max(source) when 2 then 'Both HES and CPRD' end as source
from o_close_rows group by patid, list_disease_real, diag_date, remission_date"""

# ------------------------------------------------------------------ panel
STEPS["o_years"] = f"""
select cast(y as int) as fyear, make_date(cast(y as int), 4, 1) as year_start, make_date(cast(y as int) + 1, 3, 31) as year_end
from generate_series({CFG.first_year}, {CFG.last_year}) as g(y)"""


def _skeleton(patients: str) -> str:
    return f"""
select * from (select p.*, y.fyear, y.year_start, y.year_end,
    case when p.death_date >= y.year_start and p.death_date <= y.year_end then 1 else 0 end as death
  from {patients} p cross join o_years y where p.regstartdate <= y.year_end)
where death = 1 or censor_date >= year_start"""


STEPS["o_skeleton"] = _skeleton("o_pat")
# days of a year lived under follow-up: the overlap of the year and the time from registration to censoring
_OVERLAP = "greatest(0, least(year_end, censor_date) - greatest(year_start, regstartdate{}) + 1) / (year_end - year_start + 1)"
STEPS["o_weighted"] = f"select *, {_OVERLAP.format('')} as weight from ({_skeleton('o_patient_table')})"


def share(d: str) -> str:
    """The overlap of the year, follow-up and illness. A year of death after follow-up has ended has no part in it."""
    within = f"not coalesce(death = 1 and death_date > censor_date, false) and {d} is not null"
    return f"case when {within} then {_OVERLAP.format(f', {d}')} else 0.0 end"


def inc(d: str) -> str:
    return f"""case when regstartdate >= year_start - interval 1 year then 0
  when {d} >= year_start and {d} <= year_end then 1 else 0 end"""


STEPS["o_perm_wide"] = "select patid, " + ", ".join(
    f"min(diag_date) filter (where list_disease_real = '{c}') as {column_name(c)}" for c in CFG.permanent
) + " from o_permanent group by patid"
STEPS["o_perm_panel"] = "select w.patid, w.fyear, " + ", ".join(
    f"{share('x.' + column_name(c))} as prop_{column_name(c)}, {inc('x.' + column_name(c))} as inc_{column_name(c)}"
    for c in CFG.permanent
) + " from o_weighted w left join o_perm_wide x on x.patid = w.patid"
STEPS["o_spell_years"] = f"""
select patid, list_disease_real, dy, min(diag_date) as diag_date, arg_min(remission_date, diag_date) as remission_date
from (select *, year(diag_date) - case when month(diag_date) < 4 then 1 else 0 end as dy from o_spells
      where remission_date >= date '{CFG.start}') group by patid, list_disease_real, dy"""
STEPS["o_in_force"] = """
select w.patid, w.fyear, s.list_disease_real, arg_max(s.diag_date, s.dy) as diag_date,
  arg_max(s.remission_date, s.dy) as remission_date
from o_weighted w join o_spell_years s on s.patid = w.patid and s.dy <= w.fyear
group by w.patid, w.fyear, s.list_disease_real"""
STEPS["o_res_wide"] = "select patid, fyear, " + ", ".join(
    f"min(diag_date) filter (where list_disease_real = '{c}') as {column_name(c)}, "
    f"min(remission_date) filter (where list_disease_real = '{c}') as rem_{column_name(c)}" for c in CFG.resolving
) + " from o_in_force group by patid, fyear"
STEPS["o_res_panel"] = "select w.patid, w.fyear, " + ", ".join(
    f"{share('x.' + column_name(c))} - {share('x.rem_' + column_name(c))} as prop_{column_name(c)}, "
    f"{inc('x.' + column_name(c))} as inc_{column_name(c)}" for c in CFG.resolving
) + " from o_weighted w left join o_res_wide x on x.patid = w.patid and x.fyear = w.fyear"
STEPS["o_panel"] = """
select w.*, a.* exclude (patid, fyear), b.* exclude (patid, fyear) from o_weighted w
join o_perm_panel a on a.patid = w.patid and a.fyear = w.fyear
join o_res_panel b on b.patid = w.patid and b.fyear = w.fyear"""

# ------------------------------------------------------------------ score and cells
SCORE = " + ".join(f"prop_{c} * {w}" for c, w in SCORE_WEIGHTS.items())
STEPS["o_scored"] = (
    f"select * exclude ({', '.join('prop_' + c for c in SCORE_COMPONENTS)}), {SCORE} as cam_score_general from o_panel"
)
_BANDS = list(zip(AGE_BREAKS, AGE_BREAKS[1:] + (100000,), AGE_LABELS))
AGECAT = "case " + " ".join(f"when age >= {a} and age < {b} then '{x}'" for a, b, x in _BANDS) + " end"
DECILE = "case " + " ".join(f"when imd2015_decile = {i + 1} then '{x}'" for i, x in enumerate(DECILE_LABELS)) + " end"
STEPS["o_banded"] = f"""
select *, {AGECAT} as agecat, {DECILE} as imd_deciles
from (select *, case when fyear - yob = -1 then 0 else fyear - yob end as age from o_scored)"""
STEPS["o_esp"] = f"""
select b.agecat, b.wt_esp, g.gender, d.imd_deciles, cast(y.y as int) as fyear
from (values {', '.join(f"('{a}', {float(w)})" for a, w in zip(AGE_LABELS, STANDARD_WEIGHTS))}) as b(agecat, wt_esp)
cross join (values (2), (1)) as g(gender)
cross join (values {', '.join(f"('{d}')" for d in DECILE_LABELS)}) as d(imd_deciles)
cross join generate_series({CFG.standard_first_year}, {CFG.standard_last_year}) as y(y)"""
STEPS["o_active"] = f"""
select b.*, cast(e.wt_esp as double) as wt_esp, cast(cam_score_general > 0 as int) as dum_cam_score_greater_0,
  cast(cam_score_general > 1.5 as int) as dum_cam_score_greater_1_5
from o_banded b left join o_esp e on e.agecat = b.agecat and e.gender = b.gender
  and e.imd_deciles = b.imd_deciles and e.fyear = b.fyear
where age between 30 and 99 and b.fyear >= {CFG.report_first_year} and b.fyear < {CFG.report_last_year + 1} and weight <> 0"""
STEPS["o_sized"] = """
select a.*, y.popsize_tot, s.popsize from o_active a
join (select fyear, count(distinct patid) as popsize_tot from o_active group by fyear) y on y.fyear = a.fyear
join (select fyear, agecat, gender, imd_deciles, count(distinct patid) as popsize from o_active
      group by fyear, agecat, gender, imd_deciles) s
  on s.fyear = a.fyear and s.agecat is not distinct from a.agecat and s.gender is not distinct from a.gender
  and s.imd_deciles is not distinct from a.imd_deciles"""
REPORTED = CFG.reported_columns


def _cells(values: str) -> str:
    return f"""
select c.*, popsize / popsize_tot as actual_pop_wt, wt_esp / tot_wt_esp as standard_pop_wt
from (select *, sum(wt_esp) over (partition by fyear) as tot_wt_esp from (
  select fyear, imd_deciles, imd2015_decile, agecat, gender, popsize_tot, popsize, wt_esp, {values}
  from o_sized group by all)) c"""


STEPS["o_score_cells"] = _cells("avg(cam_score_general) as cam_score_general")
STEPS["o_prev_cells"] = _cells(", ".join(
    f"sum(case when prop_{c} > 0 then 1 else 0 end) / sum(case when weight > 0 then 1 else 0 end) as prev_{c}"
    for c in REPORTED
))


def _report(cells: str, columns: list[str], weight: str, reports: dict) -> str:
    parts = []
    for name, keys in reports.items():
        used = ("fyear", *keys)
        picked = ", ".join(
            k if k in used else f"cast(null as {t}) as {k}"
            for k, t in (("fyear", "int"), ("agecat", "varchar"), ("gender", "int"), ("imd_deciles", "varchar"),
                         ("imd2015_decile", "int"))
        )
        means = ", ".join(f"round(sum({v} * {weight}) / sum({weight}), 6) as {v}" for v in columns)
        parts.append(
            f"select '{name}' as report, {picked}, {means} from {cells} where {weight} is not null "
            f"group by {', '.join(used)}"
        )
    return " union all ".join(parts)


# ------------------------------------------------------------------ code lists
def _normal(c: str) -> str:
    out = f"lower({c})"
    for a, b in ((" ", "_"), ("-", "_"), ("nos", "not_otherwise_specified"),
                 ("other_or_not_specified", "not_otherwise_specified")):
        out = f"replace({out}, '{a}', '{b}')"
    return out


STEPS["o_codes"] = """
select replace(Disease, ' ', '_') as disease, MedCodeId as medcodeid, Descr as descr, System as system,
  case when System is null then null when System = 'Cancers' then 1826
       when System = 'Mental Health Disorders' then 365 else 9999999 end as read
from code_file where MedCodeId is not null"""
STEPS["o_map1"] = f"""
select * from (select replace(Disease, ' ', '_') as Disease,
  case when list_disease_real = 'Atrial fibrilation' then 'Atrial fibrillation' else list_disease_real end as list_disease_real
  from disease_map) where list_disease_real in ({names(CFG.conditions)})"""
STEPS["o_map"] = f"""
select Disease, list_disease_real, replace({_normal('Disease')}, 'alcohol_misuse', 'alcohol_problems') as tomerge
from (select * from o_map1 union all select Disease, case
  {' '.join(f"when list_disease_real = '{a}' then '{b}'" for a, b in CFG.groups.items())} end
  from o_map1 where list_disease_real in ({names(CFG.groups)}))"""
STEPS["o_codelist"] = """
select c.disease, c.medcodeid, c.read, m.list_disease_real, c.descr from o_codes c join o_map m on m.Disease = c.disease"""
_TYPE2 = "'Type 2|type 2|type ii|Type ii|Type II|type II|non-insul|Non-insul|non insul|Non insul'"
STEPS["o_described"] = f"""
select disease, medcodeid, read, descr, case when disease = 'Alcohol_Misuse' and descr is null then null
  when disease = 'Alcohol_Misuse' and contains(descr, 'liver ') then 'Other alcohol problems'
  when disease is null and (descr is null or contains(descr, 'liver ')) then null
  else list_disease_real end as list_disease_real
from (select medcodeid, read, descr,
  case when list_disease_real = 'Diabetes excl Type 2' and descr is null then null
    when list_disease_real = 'Diabetes excl Type 2' and regexp_matches(descr, {_TYPE2})
    then 'Type_2_Diabetes_Mellitus' else disease end as disease,
  case when list_disease_real = 'Diabetes excl Type 2' and descr is null then null
    when list_disease_real = 'Diabetes excl Type 2' and regexp_matches(descr, {_TYPE2})
    then 'Diabetes Type 2' else list_disease_real end as list_disease_real
  from o_codelist)"""
STEPS["o_durations"] = f"""
select disease, medcodeid, descr, list_disease_real, case when list_disease_real in ({PERMANENT}) then 9999999
  when list_disease_real = 'Asthma' then 365 else read end as read
from (select *, row_number() over (partition by medcodeid, list_disease_real
    order by disease nulls first, descr nulls first, read nulls first) as n
  from (select disease, medcodeid, descr, list_disease_real, case when list_disease_real is null then null
      when list_disease_real = 'Alcohol problems' then 365 else read end as read from o_described))
where n = 1"""
STEPS["o_icd0"] = f"""
select *, case when k = 'chronic_kidney_disease' and OPCS4code is not null
  then 'chronic_kidney_disease_incl_test_and_proc' else k end as tomerge
from (select *, case when {_normal('Disease')} = 'end_stage_renal_disease' then 'chronic_kidney_disease'
  else {_normal('Disease')} end as k from icd_file)"""
_ALCOHOL = """case when Category = 'Diagnosis of Alcohol Problems' and contains(ICD10codeDescr, 'liver ')
    then 'alcohol_problems_other'
  when Category = 'Diagnosis of Alcohol Problems' and ICD10codeDescr is null then null
  when Category is null and (ICD10codeDescr is null or contains(ICD10codeDescr, 'liver ')) then null
  else tomerge end"""
STEPS["o_icd1"] = f"""
select * exclude (tomerge), {_ALCOHOL} as tomerge from (select * from o_icd0 union all
  select * replace ('chronic_kidney_disease_incl_test' as tomerge) from o_icd0 where tomerge = 'chronic_kidney_disease')
union all select * exclude (tomerge), 'chronic_kidney_disease_incl_test_and_proc' from o_icd0
where tomerge = 'chronic_kidney_disease'"""
STEPS["o_icd"] = """
select Disease, Category, ICD10code, ICD10codeDescr, OPCS4code,
  case e when 'primary_malignancy_lung_and_trachea' then 'primary_malignancy_lung'
         when 'primary_malignancy_colorectal_and_anus' then 'primary_malignancy_bowel' else e end as disease_tomerge
from (select *, case when ICD10code is null then null when ICD10code like 'M3%' then 'connective_tissue_disorder' else d end as e
  from (select *, case when c = 'diabetes' and not ICD10code like 'E11%' then 'type_1_diabetes_mellitus' else c end as d
    from (select *, case when ICD10code is null then null when ICD10code like 'E11%' then 'type_2_diabetes_mellitus'
      else tomerge end as c from o_icd1)))"""
STEPS["o_icd_joined"] = """
select i.ICD10code, m.list_disease_real from o_icd i join o_map m on m.tomerge = i.disease_tomerge"""
STEPS["o_expanded"] = """
select distinct ICD10code, list_disease_real from (
  select ICD10code, list_disease_real from o_icd_joined where ICD10code is not null
  union all select concat(ICD10code, '.', cast(d as varchar)), list_disease_real
  from o_icd_joined cross join generate_series(0, 9) as g(d) where length(ICD10code) = 3)"""

# ------------------------------------------------------------------ final statements
ALL_PROP = [f"prop_{c}" for c in CFG.condition_columns]
ALL_INC = [f"inc_{c}" for c in CFG.condition_columns]
DEMOGRAPHICS = ("patid, gender, yob, ethnicity, imd2015_decile, region, fyear, pracid, regstartdate, censor_date, "
                "death_date, year_start, year_end, death, round(weight, 6) as weight")


def rounded(columns) -> str:
    return ", ".join(f"round({c}, 6) as {c}" for c in columns)


def _sizes(values: list[str]) -> str:
    return ("fyear, imd_deciles, imd2015_decile, agecat, gender, cast(popsize_tot as bigint) as popsize_tot, "
            "cast(popsize as bigint) as popsize, wt_esp, tot_wt_esp, "
            + rounded([*values, "actual_pop_wt", "standard_pop_wt"]))


PERM_COLUMNS = [column_name(c) for c in CFG.permanent]
RES_COLUMNS = [column_name(c) for c in CFG.resolving]
SPELL = "patid, list_disease_real, diag_date, remission_date, disease_duration, source"

FINAL = {
    "fyear_bounds": """select o_orderkey, d, year(d) - case when month(d) < 4 then 1 else 0 end as fyear, month(d) as month,
  make_date(year(d) - case when month(d) < 4 then 1 else 0 end, 4, 1) as year_start,
  make_date(year(d) + case when month(d) < 4 then 0 else 1 end, 3, 31) as year_end,
  cast(make_date(year(d) + case when month(d) < 4 then 0 else 1 end, 4, 1)
    - make_date(year(d) - case when month(d) < 4 then 1 else 0 end, 4, 1) as int) as days
from (select o_orderkey, cast(o_orderdate as date) as d from {orders})""",
    "diag_share": f"""select patid, fyear, d, round({share('d')}, 6) as share, {inc('d')} as inc
from (select s.*, x.d from o_skeleton s join (select o_custkey, min(cast(o_orderdate as date)) as d from {{orders}}
  group by o_custkey) x on x.o_custkey = s.patid)""",
    "normalise_disease": f"""select p_partkey, {_normal('name')} as plain,
  replace({_normal('name')}, 'alcohol_misuse', 'alcohol_problems') as mapped from names""",
    "load_codelist": "select disease, medcodeid, descr, system, cast(read as int) as read from o_codes",
    "codelist_groups": "select disease, medcodeid, cast(read as int) as read, list_disease_real, descr from o_codelist",
    "description_rules": "select disease, medcodeid, cast(read as int) as read, list_disease_real, descr from o_described",
    "code_durations": "select disease, medcodeid, cast(read as int) as read, list_disease_real, descr from o_durations",
    "icd_clean": "select * from o_icd",
    "icd_expand": "select * from o_expanded",
    "icd_lookup": """select e.ICD10code, d.list_disease_real, cast(d.read as int) as disease_duration
from (select distinct list_disease_real, read from o_durations) d
left join o_expanded e on e.list_disease_real = d.list_disease_real""",
    "prodcode_map": """select distinct l.cond, g.dmd_code as dmd, p.ProdCodeId as prodcodeid from drug_list l
join gemscript_map g on g.gemscript_drug_code = l.gemscriptcode join products p on p.dmdid = g.dmd_code
where l.cond in ('CON150', 'PNC166', 'PNC167')""",
    "practice_exclusion": "select * from o_kept",
    "dedupe_linked": "select * from o_deduped",
    "death_dates": "select patid, cprd_ddate, death_date from o_death",
    "practice_attributes": """select p.patid, p.pracid, cast(case when p.pracid in (5, 9) then 2 else r.region end as int) as region,
  r.lcd from o_kept p left join practice r on r.pracid = p.pracid""",
    "censor_dates": "select patid, pracid, yob, gender, regstartdate, regenddate, cprd_ddate, death_date, region, lcd, "
                    "censor_date from o_pat",
    "clean_observations": "select patid, obsid, medcodeid, obstypeid, obsdate, enterdate from o_clean1",
    "clean_birth_year": "select patid, obsid, medcodeid, obstypeid, obsdate, enterdate, yob from o_clean2",
    "restrict_drugs": "select * from drug_issue where patid in (select patid from o_pat)",
    "clean_episode_dates": "select patid, epikey, case when epistart is null then epiend else epistart end as epistart, "
                           "epiend, icd from inpatient",
    "clean_procedure_dates": "select patid, epikey, case when evdate is null then epistart else evdate end as evdate, "
                             "epistart from procedures",
    "outpatient_join": "select * from o_op",
    "ethnicity_sources": "select * from o_eth",
    "ethnicity_gp_codes": """select o.patid, o.obsdate, e.Term, e.Group1, e.Group2, e.Group3, 'CPRD' as source
from o_clean2 o join ethnic_codes e on e.medcodeid = o.medcodeid where o.obstypeid <> 4""",
    "ethnicity_modal": "select * from o_modal",
    "patient_table": "select patid, pracid, yob, gender, regstartdate, regenddate, cprd_ddate, death_date, region, lcd, "
                     "censor_date, imd2015_decile, ethnicity from o_patient_table",
    "inpatient_dx": "select * from o_dx_in",
    "outpatient_dx_long": "select * from o_op_codes",
    "outpatient_dx": "select * from o_dx_out",
    "hospital_dx": "select * from o_hospital",
    "gp_dx": "select * from o_gp",
    "permanent_dx": "select * from o_permanent",
    "resolving_events": "select patid, list_disease_real, obsdate, disease_duration, source, before, "
                        "cast(n = 1 as int) as first_epi from o_lagged",
    "spells_noncancer": f"select {SPELL} from o_noncancer",
    "spells_cancer": f"select {SPELL} from o_cancer",
    "spells_all_cancer": f"select {SPELL} from o_all_cancer",
    "spells_resolving": f"select {SPELL} from o_resolving",
    "spell_merge": "select * from o_close_rows",
    "spell_source": "select * from o_spells",
    "first_epilepsy": "select * from o_epilepsy",
    "rx_candidates": "select * from o_candidates",
    "rx_flag4": "select patid, cond, issuedate, prodcodeid, flag from o_flagged",
    "rx_exclusion": "select patid, cond, issuedate, prodcodeid, flag from o_rx_kept",
    "rx_spells": f"select {SPELL} from o_rx",
    "panel_skeleton": "select patid, fyear, year_start, year_end, regstartdate, censor_date, death_date, yob, death "
                      "from o_skeleton",
    "panel_weight": "select patid, fyear, death, round(weight, 6) as weight from o_weighted",
    "panel_permanent": f"select patid, fyear, {rounded('prop_' + c for c in PERM_COLUMNS)} from o_perm_panel",
    "panel_resolving": f"select patid, fyear, {rounded('prop_' + c for c in RES_COLUMNS)} from o_res_panel",
    "incidence": f"select patid, fyear, {', '.join(ALL_INC)} from o_panel",
    "panel_final": f"select {DEMOGRAPHICS}, {rounded(ALL_PROP)}, {', '.join(ALL_INC)} from o_panel",
    "score": "select patid, fyear, round(cam_score_general, 6) as cam_score_general from o_scored",
    "age_bands": "select patid, fyear, age, agecat, imd2015_decile, imd_deciles from o_banded",
    "std_weights": f"""select e.agecat, e.gender, e.imd_deciles, e.fyear, cast(e.wt_esp as double) as wt_esp,
  count(b.patid) as patients from o_esp e left join (select patid, fyear, gender, {AGECAT} as agecat, {DECILE} as imd_deciles
    from (select *, case when fyear - yob = -1 then 0 else fyear - yob end as age from o_weighted)) b
  on b.agecat = e.agecat and b.gender = e.gender and b.imd_deciles = e.imd_deciles and b.fyear = e.fyear
group by all""",
    "active_set": """select patid, fyear, agecat, gender, imd_deciles, wt_esp, dum_cam_score_greater_0,
  dum_cam_score_greater_1_5, popsize_tot, popsize from o_sized""",
    "score_cells": f"select {_sizes(['cam_score_general'])} from o_score_cells",
    "score_crude": _report("o_score_cells", ["cam_score_general"], "actual_pop_wt", SCORE_CRUDE_REPORTS),
    "score_standardised": _report("o_score_cells", ["cam_score_general"], "standard_pop_wt", SCORE_STANDARD_REPORTS),
    "prev_cells": f"select {_sizes([f'prev_{c}' for c in REPORTED])} from o_prev_cells",
    "prev_crude": _report("o_prev_cells", [f"prev_{c}" for c in REPORTED], "actual_pop_wt", PREVALENCE_CRUDE_REPORTS),
    "prev_standardised": _report("o_prev_cells", [f"prev_{c}" for c in REPORTED], "standard_pop_wt",
                                 PREVALENCE_STANDARD_REPORTS),
    "strip_prefix": "select o_orderkey as orderkey, o_custkey as custkey, o_orderstatus as orderstatus, "
                    "o_totalprice as totalprice, o_orderpriority as orderpriority from {orders}",
    "drop_null_columns": "select o_orderkey, o_orderstatus from {orders}",
    "roundtrip_delimited": "select patid, gender, regstartdate, regenddate from patient",
}
FINAL["codelist_folder"] = FINAL["load_codelist"]
FINAL["cohort_folders"] = FINAL["censor_dates"]
FINAL["written_reports"] = FINAL["reports_from_halves"] = f"{FINAL['score_crude']} union all {FINAL['score_standardised']}"

FINAL["deprivation_file"] = "select * from deprivation"
FINAL["drug_list_folder"] = "select * from drug_list"
FINAL["study_from_files"] = FINAL["panel_refreshed"] = FINAL["panel_bucketed"] = FINAL["panel_final"]
FINAL["unlike_files"] = """
select o_orderkey as orderid, o_custkey as custid, cast(o_orderdate as date) as made, round(o_totalprice, 2) as total from {orders}"""
FINAL["rejected_rows"] = """
select 'o_orderkey' as "column", concat(cast(o_orderkey as string), 'x') as value from {orders} where o_orderkey % 10 = 0
union all
select 'total' as "column", 'none' as value from {orders} where o_orderkey % 7 = 0"""
STEPS["o_op_repaired"] = """
select patid, apptdate as obsdate, case when length(s) <= 3 or substr(s, 4) = 'X' then substr(s, 1, 3)
  else concat(substr(s, 1, 3), '.', replace(substr(s, 4, 1), 'X', '0')) end as ICD10code
from (select patid, apptdate, regexp_replace(icd, '[^[:alnum:]]', '', 'g') as s
  from (select patid, apptdate, unnest([diag_01, diag_02, diag_03]) as icd from o_op) where icd <> '')"""
FINAL["outpatient_dx_repaired"] = f"""
select distinct h.patid, h.obsdate, k.list_disease_real, k.disease_duration, 'HES' as source, {_REMISSION}
from o_op_repaired h join icd_codes k on k.ICD10code = h.ICD10code"""
FINAL["skeleton_without_death_years"] = "select patid, fyear, death from o_skeleton where censor_date >= year_start"
STEPS["o_strict_cells"] = """
select * replace (case when bool_or(wt_esp is null) over (partition by fyear) then null else standard_pop_wt end as standard_pop_wt)
from o_score_cells"""
FINAL["score_strict"] = _report("o_strict_cells", ["cam_score_general"], "standard_pop_wt", SCORE_STANDARD_REPORTS).replace(
    " where standard_pop_wt is not null", "")

TABLES = {**SQL, **STEPS}
#: A run from files uses the code tables it builds.
BUILT = {
    "codelist": "select * from o_durations",
    "icd_codes": FINAL["icd_lookup"],
    "prodcodes": f"select distinct cond, prodcodeid from ({FINAL['prodcode_map']}) m",
}


def _needed(sql: str, tables: dict[str, str]) -> list[str]:
    """Adapters and steps a statement uses, each after those it uses itself."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in tables:
            if name not in order and re.search(rf"(?:from|join)\s+{name}\b", text):
                visit(tables[name])
                order.append(name)

    visit(sql)
    return order


def oracle(name: str) -> str:
    sql, tables = FINAL[name], TABLES | BUILT if name == "study_from_files" else TABLES
    steps = ",\n".join(f"{n} as ({tables[n].strip()})" for n in _needed(sql, tables))
    whole = f"with {steps}\n{sql}" if steps else sql
    for table in ("nation", "customer", "part", "orders", "lineitem"):
        whole = whole.replace("{" + table + "}", table)
    return whole
