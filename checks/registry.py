"""The registered queries: each runs one operator, or a chain of them, over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.adapters import CFG, Fixture
from morbidity.config import (
    PREVALENCE_CRUDE_REPORTS,
    PREVALENCE_STANDARD_REPORTS,
    SCORE_CRUDE_REPORTS,
    SCORE_STANDARD_REPORTS,
    column_name,
)
from morbidity.functions import dates
from morbidity.functions.text import normalise_disease
from morbidity.operators import (
    clean,
    codelists,
    cohort,
    demographics,
    diagnosis,
    joins,
    panel,
    prescriptions,
    reports,
    score,
    spells,
    standardise,
)
from morbidity.plans import from_files, refresh, study
from morbidity.sources import files, readers, schemas, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SPELL = list(spells.SPELL)
DEMOGRAPHICS = list(panel.FIRST_COLUMNS)
CELL_COLUMNS = ("fyear", "imd_deciles", "imd2015_decile", "agecat", "gender", "popsize_tot", "popsize", "wt_esp",
                "tot_wt_esp")
REPORT_COLUMNS = ("report", "fyear", "agecat", "gender", "imd_deciles", "imd2015_decile")
PROPS = [f"prop_{c}" for c in CFG.condition_columns]
INCS = [f"inc_{c}" for c in CFG.condition_columns]


def query(build: Callable[[Fixture], DataFrame]) -> Callable[[Fixture], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Fixture(spark, sf_dir))
    return build


def rounded(df: DataFrame, kept: list[str] | tuple, values: list[str]) -> DataFrame:
    return df.selectExpr(*kept, *[f"round({v}, 6) as {v}" for v in values])


# ---------------------------------------------------------------- functions
@query
def fyear_bounds(f: Fixture) -> DataFrame:
    d, fyear = F.col("d"), F.col("fyear")
    df = f.base("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    bounds = df.withColumn("fyear", dates.fyear_of(d)).withColumns(
        {"month": F.month(d), "year_start": dates.year_start(fyear), "year_end": dates.year_end(fyear)}
    )
    return bounds.withColumn("days", dates.days_between(F.col("year_start"), F.col("year_end")))


@query
def diag_share(f: Fixture) -> DataFrame:
    first = f.base("orders").groupBy(F.col("o_custkey").alias("patid")).agg(
        F.min(F.col("o_orderdate").cast("date")).alias("d")
    )
    rows = panel.with_bounds(panel.panel_skeleton(eligible(f), CFG).join(first, "patid"))
    share = f"round({panel.days_in_bounds('d')} / year_days, 6) as share"
    return rows.selectExpr("patid", "fyear", "d", share, f"{panel.incident_in_bounds('d')} as inc")


# ---------------------------------------------------------------- code lists
@query
def normalise_disease_names(f: Fixture) -> DataFrame:
    c = F.col("name")
    return f.names.select(
        "p_partkey", normalise_disease(c).alias("plain"), normalise_disease(c, map_side=True).alias("mapped")
    )


QUERIES["normalise_disease"] = QUERIES.pop("normalise_disease_names")


def grouped_map(f: Fixture) -> DataFrame:
    return codelists.with_groups(readers.clean_disease_map(f.disease_map, CFG), CFG)


@query
def load_codelist(f: Fixture) -> DataFrame:
    return codelists.load_codelist(f.code_file)


@query
def codelist_groups(f: Fixture) -> DataFrame:
    return codelists.build_codelist(load_codelist(f), grouped_map(f))


@query
def description_rules(f: Fixture) -> DataFrame:
    return codelists.apply_description_rules(codelist_groups(f))


@query
def code_durations(f: Fixture) -> DataFrame:
    return codelists.set_durations(description_rules(f), CFG)


@query
def icd_clean(f: Fixture) -> DataFrame:
    return codelists.clean_icd(f.icd_file, CFG)


@query
def icd_expand(f: Fixture) -> DataFrame:
    named = joins.lookup_join(icd_clean(f), grouped_map(f).select("disease_tomerge", "list_disease_real"),
                              "disease_tomerge")
    return codelists.expand_icd(named)


@query
def icd_lookup(f: Fixture) -> DataFrame:
    return codelists.icd_lookup(icd_clean(f), grouped_map(f), code_durations(f))


@query
def prodcode_map(f: Fixture) -> DataFrame:
    return codelists.build_prodcodes(f.drug_list, f.gemscript_map, f.products, CFG)


# ---------------------------------------------------------------- cohort
@query
def practice_exclusion(f: Fixture) -> DataFrame:
    return cohort.drop_duplicate_practices(f.patient, CFG)


@query
def dedupe_linked(f: Fixture) -> DataFrame:
    return cohort.dedupe_linked(practice_exclusion(f), f.hospital_link)


@query
def death_dates(f: Fixture) -> DataFrame:
    dated = cohort.with_death_date(dedupe_linked(f), f.death_register, CFG)
    return dated.select("patid", "cprd_ddate", "death_date")


@query
def practice_attributes(f: Fixture) -> DataFrame:
    return cohort.with_practice(practice_exclusion(f), f.practice, CFG).select("patid", "pracid", "region", "lcd")


def eligible(f: Fixture) -> DataFrame:
    return study.eligible_patients(f.tables, CFG)


@query
def censor_dates(f: Fixture) -> DataFrame:
    return eligible(f)


# ---------------------------------------------------------------- cleaning
@query
def clean_observations(f: Fixture) -> DataFrame:
    return clean.clean_observation_dates(f.observation, CFG)


@query
def clean_birth_year(f: Fixture) -> DataFrame:
    return clean.clean_birth_year(clean_observations(f), eligible(f))


@query
def restrict_drugs(f: Fixture) -> DataFrame:
    return joins.restrict_to(f.drug_issue, eligible(f))


@query
def clean_episode_dates(f: Fixture) -> DataFrame:
    return clean.fill_date(f.inpatient, "epistart", "epiend")


@query
def clean_procedure_dates(f: Fixture) -> DataFrame:
    return clean.fill_date(f.procedures, "evdate", "epistart")


@query
def outpatient_join(f: Fixture) -> DataFrame:
    return clean.outpatient_diagnoses(f.op_clinical, f.op_appointment)


# ---------------------------------------------------------------- demographics
@query
def ethnicity_sources(f: Fixture) -> DataFrame:
    return study.ethnicity_records(f.tables, observations(f), CFG)


@query
def ethnicity_gp_codes(f: Fixture) -> DataFrame:
    return demographics.gp_ethnicity_codes(observations(f), f.ethnic_codes, CFG)


@query
def ethnicity_modal(f: Fixture) -> DataFrame:
    return study.ethnicity(f.tables, observations(f), CFG)


@query
def patient_table(f: Fixture) -> DataFrame:
    return studied(f)


# ---------------------------------------------------------------- diagnoses
@query
def inpatient_dx(f: Fixture) -> DataFrame:
    return diagnosis.inpatient_dx(clean_episode_dates(f), f.icd_codes, CFG)


@query
def outpatient_dx_long(f: Fixture) -> DataFrame:
    codes = diagnosis.outpatient_codes(outpatient_join(f), CFG)
    return codes.select("patid", F.col("apptdate").alias("obsdate"), "ICD10code")


@query
def outpatient_dx(f: Fixture) -> DataFrame:
    return diagnosis.outpatient_dx(f.op_clinical, f.op_appointment, f.icd_codes, CFG)


@query
def hospital_dx(f: Fixture) -> DataFrame:
    return study.hospital_events(f.tables, eligible(f), CFG)


def observations(f: Fixture) -> DataFrame:
    return study.coded_events(f.tables, eligible(f), CFG)


@query
def gp_dx(f: Fixture) -> DataFrame:
    return diagnosis.gp_dx(observations(f), f.codelist, CFG)


@query
def permanent_dx(f: Fixture) -> DataFrame:
    gp = diagnosis.gp_events(observations(f), CFG)
    return diagnosis.permanent_dx(gp, hospital_dx(f), f.codelist, CFG)


def events(f: Fixture) -> DataFrame:
    gp = diagnosis.gp_events(observations(f), CFG)
    return diagnosis.resolving_events(gp, hospital_dx(f), f.codelist, CFG)


@query
def resolving_events(f: Fixture) -> DataFrame:
    return spells.event_intervals(events(f))


# ---------------------------------------------------------------- spells
@query
def spells_noncancer(f: Fixture) -> DataFrame:
    return spells.gap_spells(events(f).where(F.col("list_disease_real").isin(*CFG.resolving_non_cancer)))


@query
def spells_cancer(f: Fixture) -> DataFrame:
    return spells.first_cancer_spells(events(f), CFG)


@query
def spells_all_cancer(f: Fixture) -> DataFrame:
    return spells.all_cancer_spell(spells_cancer(f), CFG)


@query
def spells_resolving(f: Fixture) -> DataFrame:
    return spells.resolving_spells(events(f), CFG)


def found(f: Fixture) -> DataFrame:
    """All spells before close ones are merged."""
    patients = writers.stage(eligible(f), "patients")
    seen = writers.stage(study.coded_events(f.tables, patients, CFG), "observations")
    stays = study.hospital_events(f.tables, patients, CFG)
    coded = diagnosis.resolving_events(diagnosis.gp_events(seen, CFG), stays, f.codelist, CFG)
    drugs = study.prescription_spells(f.tables, seen, patients, CFG)
    return spells.resolving_spells(coded, CFG).unionByName(drugs)


@query
def spell_merge(f: Fixture) -> DataFrame:
    return spells.merge_close_spells(found(f), CFG.merge_days)


@query
def spell_source(f: Fixture) -> DataFrame:
    return spells.merge_sources(spell_merge(f))


# ---------------------------------------------------------------- prescriptions
@query
def first_epilepsy(f: Fixture) -> DataFrame:
    return prescriptions.first_date(observations(f), f.codelist.where("disease = 'Epilepsy'"), CFG)


@query
def rx_candidates(f: Fixture) -> DataFrame:
    listed = prescriptions.rx_candidates(f.drug_issue, f.prodcodes, CFG)
    return listed.join(eligible(f).select("patid"), "patid", "left_semi")


@query
def rx_flag4(f: Fixture) -> DataFrame:
    return prescriptions.rx_flag(rx_candidates(f), CFG)


@query
def rx_exclusion(f: Fixture) -> DataFrame:
    return prescriptions.exclude_after(rx_flag4(f), first_epilepsy(f), CFG.rx_excluded_after_epilepsy)


@query
def rx_spells(f: Fixture) -> DataFrame:
    return prescriptions.rx_spells(rx_exclusion(f), CFG).select(*SPELL)


# ---------------------------------------------------------------- panel
@query
def panel_skeleton(f: Fixture) -> DataFrame:
    return panel.panel_skeleton(eligible(f), CFG).select(
        "patid", "fyear", "year_start", "year_end", "regstartdate", "censor_date", "death_date", "yob", "death"
    )


def studied(f: Fixture) -> DataFrame:
    return demographics.patient_table(eligible(f), f.deprivation, ethnicity_modal(f))


def weighted(f: Fixture) -> DataFrame:
    return panel.with_weight(panel.panel_skeleton(studied(f), CFG))


@query
def panel_weight(f: Fixture) -> DataFrame:
    return rounded(weighted(f), ["patid", "fyear", "death"], ["weight"])


@query
def panel_permanent(f: Fixture) -> DataFrame:
    props = [f"prop_{column_name(c)}" for c in CFG.permanent]
    return rounded(panel.permanent_panel(studied(f), permanent_dx(f), CFG), ["patid", "fyear"], props)


@query
def panel_resolving(f: Fixture) -> DataFrame:
    props = [f"prop_{column_name(c)}" for c in CFG.resolving]
    return rounded(panel.resolving_panel(studied(f), spell_source(f), CFG), ["patid", "fyear"], props)


def whole_panel(f: Fixture) -> DataFrame:
    return study.study_panel(f.tables, CFG)


@query
def incidence(f: Fixture) -> DataFrame:
    return whole_panel(f).select("patid", "fyear", *INCS)


@query
def panel_final(f: Fixture) -> DataFrame:
    kept = [c for c in DEMOGRAPHICS if c != "weight"]
    return whole_panel(f).selectExpr(*kept, *[f"round({c}, 6) as {c}" for c in ["weight", *PROPS]], *INCS)


# ---------------------------------------------------------------- score, standardisation, reports
@query
def score_rows(f: Fixture) -> DataFrame:
    return rounded(score.with_score(whole_panel(f), CFG), ["patid", "fyear"], ["cam_score_general"])


QUERIES["score"] = QUERIES.pop("score_rows")


@query
def age_bands(f: Fixture) -> DataFrame:
    return standardise.with_bands(whole_panel(f)).select(
        "patid", "fyear", "age", "agecat", "imd2015_decile", "imd_deciles"
    )


@query
def std_weights(f: Fixture) -> DataFrame:
    keys = ["agecat", "gender", "imd_deciles", "fyear"]
    people = standardise.with_bands(weighted(f)).groupBy(*keys).agg(F.count(F.lit(1)).alias("patients"))
    weights = standardise.standard_population(f.spark, CFG)
    return weights.join(people, keys, "left").withColumn("patients", F.coalesce("patients", F.lit(0)))


def active(f: Fixture) -> DataFrame:
    return study.reported_rows(whole_panel(f), CFG)


@query
def active_set(f: Fixture) -> DataFrame:
    rows = study.reported_rows(writers.stage(whole_panel(f), "panel"), CFG)
    return standardise.active_set(rows).select(
        "patid", "fyear", "agecat", "gender", "imd_deciles", "wt_esp", "dum_cam_score_greater_0",
        "dum_cam_score_greater_1_5", "popsize_tot", "popsize",
    )


WEIGHTS = ["actual_pop_wt", "standard_pop_wt"]


@query
def score_cells(f: Fixture) -> DataFrame:
    return rounded(standardise.report_cells(active(f), CFG), CELL_COLUMNS, ["cam_score_general", *WEIGHTS])


@query
def score_crude(f: Fixture) -> DataFrame:
    cells = standardise.report_cells(active(f), CFG)
    value = ["cam_score_general"]
    return rounded(reports.weighted_report(cells, value, WEIGHTS[0], SCORE_CRUDE_REPORTS), REPORT_COLUMNS, value)


@query
def score_standardised(f: Fixture) -> DataFrame:
    cells = standardise.report_cells(active(f), CFG)
    value = ["cam_score_general"]
    return rounded(reports.weighted_report(cells, value, WEIGHTS[1], SCORE_STANDARD_REPORTS), REPORT_COLUMNS, value)


PREVS = [f"prev_{c}" for c in CFG.reported_columns]


@query
def prev_cells(f: Fixture) -> DataFrame:
    return rounded(standardise.report_cells(active(f), CFG), CELL_COLUMNS, [*PREVS, *WEIGHTS])


@query
def prev_crude(f: Fixture) -> DataFrame:
    cells = standardise.report_cells(active(f), CFG)
    return rounded(reports.weighted_report(cells, PREVS, WEIGHTS[0], PREVALENCE_CRUDE_REPORTS), REPORT_COLUMNS, PREVS)


@query
def prev_standardised(f: Fixture) -> DataFrame:
    cells = standardise.report_cells(active(f), CFG)
    report = reports.weighted_report(cells, PREVS, WEIGHTS[1], PREVALENCE_STANDARD_REPORTS)
    return rounded(report, REPORT_COLUMNS, PREVS)


# ---------------------------------------------------------------- sources and sinks
@query
def strip_prefix(f: Fixture) -> DataFrame:
    kept = f.base("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return readers.strip_prefix(kept, "o_")


@query
def drop_null_columns(f: Fixture) -> DataFrame:
    empty = F.when(F.col("o_totalprice") < 0, F.col("o_orderpriority")).alias("never_filled")
    return readers.drop_all_null_columns(f.base("orders").select("o_orderkey", empty, "o_orderstatus"))


def _folder(f: Fixture, name: str) -> str:
    return f"{writers.shared_folder(f.spark)}/{name}-{uuid.uuid4().hex}"


@query
def roundtrip_delimited(f: Fixture) -> DataFrame:
    """Patients written as day-first tab-delimited text, read back in given types."""
    path = _folder(f, "delimited")
    kept = f.patient.select("patid", "gender", "regstartdate", "regenddate")
    kept.write.option("sep", "\t").option("header", True).option("dateFormat", "dd/MM/yyyy").csv(path)
    schema = "patid long, gender int, regstartdate date, regenddate date"
    return readers.read_delimited(f.spark, path, schema)


@query
def codelist_folder(f: Fixture) -> DataFrame:
    """Code lists written as a folder of CSV files, read back as one table."""
    path = _folder(f, "codes")
    f.code_file.write.option("header", True).csv(path)
    schema = "Disease string, MedCodeId long, Descr string, System string"
    return codelists.load_codelist(readers.read_codelist_dir(f.spark, path, schema))


@query
def cohort_folders(f: Fixture) -> DataFrame:
    """Patients written in folders by bucket, read back whole."""
    path = _folder(f, "cohorts")
    writers.write_table(cohort.with_bucket(eligible(f), 16), path, ["bucket"])
    return readers.read_table(f.spark, path, eligible(f).columns)


@query
def written_reports(f: Fixture) -> DataFrame:
    """The score reports, written in folders by report and read back."""
    path = _folder(f, "reports")
    cells = writers.stage(standardise.report_cells(active(f), CFG), "cells")
    writers.write_reports({"score": study.score_reports(cells, CFG)}, path)
    back = f.spark.read.parquet(f"{path}/score")
    return rounded(back, REPORT_COLUMNS, ["cam_score_general"])


@query
def reports_from_halves(f: Fixture) -> DataFrame:
    """The score reports from the merged cell states of two halves of the patients."""
    rows = active(f)
    halves = [writers.stage(standardise.cell_states(rows.where(F.col("patid") % 2 == k), CFG), "states") for k in (0, 1)]
    return rounded(study.merged_reports(halves, CFG)["score"], REPORT_COLUMNS, ["cam_score_general"])


@query
def deprivation_file(f: Fixture) -> DataFrame:
    """Text whose columns stand in another order, with a prefix and with one more, read by name."""
    path = _folder(f, "deprivation")
    mixed = f.deprivation.select(
        F.lit(900).alias("e_pracid"), F.col("imd2015_decile").alias("imd2015_decile"), F.col("patid").alias("e_patid")
    )
    mixed.write.option("sep", "\t").option("header", True).csv(path)
    return readers.read_delimited(f.spark, path, schemas.DEPRIVATION, prefix="e_")


@query
def drug_list_folder(f: Fixture) -> DataFrame:
    """Drug lists in files named by list, with columns that differ from file to file."""
    path = _folder(f, "drugs")
    _write_drug_lists(f, path)
    return readers.read_tagged_dir(f.spark, path, schemas.DRUG_LIST)


def _write_drug_lists(f: Fixture, path: str) -> None:
    for n, cond in enumerate(("CON150", "PNC166", "PNC167", "ASM123")):
        listed = f.drug_list.where(F.col("cond") == cond).select("gemscriptcode")
        wide = listed.select(*[F.lit("x").alias(f"more{i}") for i in range(n)], "gemscriptcode", F.lit(1).alias("last"))
        wide.write.option("header", True).csv(f"{path}/CPRDCAM_{cond}_PC_V1-1_Oct.csv")


def write_raw_files(f: Fixture, root: str) -> None:
    """The test tables as the files a run starts from: prefixed names, other column orders, day-first dates."""
    tables = {name: getattr(f.tables, name) for name in from_files.EVENTS if name != "procedure"}
    tables["procedure"] = f.procedures
    for i, (name, df) in enumerate(tables.items()):
        source = from_files.EVENTS[name]
        in_file = {v: k for k, v in source.renamed.items()}
        picked = []
        for column, kind in source.fields():
            value = F.col(column) if column in df.columns else F.lit(None)
            day = kind == "date" or dict(df.dtypes).get(column) == "date"
            text = F.date_format(value, "dd/MM/yyyy") if day else value.cast("string")
            there = in_file.get(column, column)
            picked.append(text.alias(f"e_{there}" if i % 2 else there))
        picked = [*picked[::-1], F.lit("z").alias("more")] if i % 3 else picked
        df.select(*picked).write.option("sep", "\t").option("header", True).csv(f"{root}/{name}")
    even = f.code_file.where("MedCodeId % 2 = 0 or System is null").select("system", "medcodeid", "disease", "descr")
    odd = f.code_file.where("not (MedCodeId % 2 = 0 or System is null)").select("Disease", F.lit(1).alias("n"), "MedCodeId", "Descr", "System")
    even.write.option("header", True).csv(f"{root}/codelists")
    odd.write.option("header", True).mode("append").csv(f"{root}/codelists")
    f.icd_file.write.option("header", True).csv(f"{root}/icd")
    f.disease_map.withColumnRenamed("list_disease_real", "Disease (REAL)").write.option("header", True).csv(f"{root}/disease_map")
    _write_drug_lists(f, f"{root}/drug_lists")
    lookups = {"gemscript_map": (f.gemscript_map, "|"), "products": (f.products, "\t"), "gp_ethnicity_lookup": (f.ethnic_codes, ","),
               "hospital_ethnicity_lookup": (f.ethnic_groups, "\t")}
    for name, (df, sep) in lookups.items():
        df.write.option("header", True).option("sep", sep).csv(f"{root}/{name}")


@query
def study_from_files(f: Fixture) -> DataFrame:
    """The panel of a run from raw text files, with the code tables that it builds from its lists."""
    root = _folder(f, "files")
    write_raw_files(f, root)
    whole = from_files.run(f.spark, root, _folder(f, "run"), CFG)
    kept = [c for c in DEMOGRAPHICS if c != "weight"]
    return whole.selectExpr(*kept, *[f"round({c}, 6) as {c}" for c in ["weight", *PROPS]], *INCS)


@query
def unlike_files(f: Fixture) -> DataFrame:
    """Orders in 200 files that differ in the order, case and prefix of their columns, in further columns and in separator; one scan reads those of a separator."""
    path = _folder(f, "unlike")
    write_unlike_files(f, path)
    return files.parsed(files.read_source(f.spark, f"{path}/file=*", ORDERS))


ORDERS = files.Source("orderid long, custid long, made date, total double", prefix="o_", renamed={"order key": "orderid", "cust": "custid"})


def write_unlike_files(f: Fixture, path: str, n: int = 200) -> None:
    """A header and lines for each file; file numbers, taken by remainders, choose the shape."""
    number = F.pmod(F.col("o_orderkey"), F.lit(n)).cast("int")
    values = {"id": F.col("o_orderkey").cast("string"), "cust": F.col("o_custkey").cast("string"),
              "made": F.date_format("o_orderdate", "dd/MM/yyyy"), "total": F.format_string("%.2f", "o_totalprice"), "more": F.lit("x")}
    shapes = (
        ("\t", {"id": "o_orderid", "cust": "o_custid", "made": "o_made", "total": "o_total"}),
        ("\t", {"more": "note", "total": "TOTAL", "made": "Made", "cust": "Cust", "id": "Order Key"}),
        ("|", {"made": "made", "id": "ORDERID", "more": "x", "total": "total", "cust": "custid"}),
    )
    line, head = F.lit(None), F.lit(None)
    for k, (sep, columns) in enumerate(shapes):
        mine = F.col("file") % len(shapes) == k
        line = F.when(mine, F.concat_ws(sep, *[values[c] for c in columns])).otherwise(line)
        head = F.when(mine, F.lit(sep.join(columns.values()))).otherwise(head)
    lines = f.base("orders").withColumn("file", number).select("file", F.lit(1).alias("nth"), line.alias("value"))
    heads = f.spark.range(n).select(F.col("id").cast("int").alias("file")).select("file", F.lit(0).alias("nth"), head.alias("value"))
    whole = lines.unionByName(heads).repartition("file").sortWithinPartitions("file", "nth")
    whole.select("file", "value").write.partitionBy("file").text(path)


@query
def rejected_rows(f: Fixture) -> DataFrame:
    """Text that does not parse, by column, found in the pass that writes the table."""
    path, source = _folder(f, "orders"), files.Source("o_orderkey long, made date, total double")
    broken = f.base("orders").select(
        F.concat(F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 10 == 0, F.lit("x")).otherwise(F.lit(""))).alias("O_ORDERKEY"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("made"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("none")).when(F.col("o_orderkey") % 7 == 1, F.lit(" ")).otherwise(F.format_string("%.2f", "o_totalprice")).alias("total"),
    )
    broken.write.option("header", True).csv(path)
    read = writers.stage(files.read_source(f.spark, path, source), "orders")
    return files.rejects(read).select("column", "value")


@query
def panel_refreshed(f: Fixture) -> DataFrame:
    """A panel made without the observations of some patients, then brought up to date: only their buckets are made again."""
    folder = _folder(f, "refreshed")
    # tables that are joins of test tables are written first, as a refresh reads each several times
    tables = replace(f.tables, **{name: writers.stage(getattr(f.tables, name), name) for name in ("observation", "drug_issue")})
    refresh.refresh(replace(tables, observation=tables.observation.where("patid % 50 <> 3")), CFG, folder, 64)
    whole = refresh.refresh(tables, CFG, folder, 64)
    kept = [c for c in DEMOGRAPHICS if c != "weight"]
    return whole.selectExpr(*kept, *[f"round({c}, 6) as {c}" for c in ["weight", *PROPS]], *INCS)


@query
def panel_bucketed(f: Fixture) -> DataFrame:
    """The panel from tables that are stored by patient."""
    tables, keep = study.by_patient(f.tables, 8)
    kept = [c for c in DEMOGRAPHICS if c != "weight"]
    return study.study_panel(tables, CFG, keep).selectExpr(*kept, *[f"round({c}, 6) as {c}" for c in ["weight", *PROPS]], *INCS)


# ---------------------------------------------------------------- options
@query
def outpatient_dx_repaired(f: Fixture) -> DataFrame:
    return diagnosis.outpatient_dx(f.op_clinical, f.op_appointment, f.icd_codes, replace(CFG, fix_icd=True))


@query
def skeleton_without_death_years(f: Fixture) -> DataFrame:
    return panel.panel_skeleton(eligible(f), replace(CFG, keep_death=False)).select("patid", "fyear", "death")


@query
def score_strict(f: Fixture) -> DataFrame:
    """Standardised scores of years in which every cell has a standard weight; in the others they are null."""
    cfg = replace(CFG, strict=True)
    cells = standardise.report_cells(active(f), cfg)
    value = ["cam_score_general"]
    report = reports.weighted_report(cells, value, WEIGHTS[1], SCORE_STANDARD_REPORTS, strict=True)
    return rounded(reports.in_order(report), REPORT_COLUMNS, value)
