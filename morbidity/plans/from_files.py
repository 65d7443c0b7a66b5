"""A run that starts from the raw files: lists and events as text, everything else is built from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from morbidity.config import DRUG_LIST_GLOB, DRUG_LIST_TAG, Config
from morbidity.operators import codelists
from morbidity.plans import study
from morbidity.sources import readers, schemas, writers
from morbidity.sources.files import Source, parsed, read_source, rejects

#: Event and patient tables, tab-delimited: folder -> what its files hold. Names may carry the prefix ``e_``.
EVENTS = {
    name: Source(schema, prefix="e_", separators="\t", renamed=renamed)
    for name, schema, renamed in (
        ("patient", schemas.PATIENT, {}),
        ("practice", schemas.PRACTICE, {}),
        ("hospital_link", schemas.HOSPITAL_LINK, {}),
        ("death_register", schemas.DEATH_REGISTER, {}),
        ("deprivation", schemas.DEPRIVATION, {"imd2015_10": "imd2015_decile"}),
        ("observation", schemas.OBSERVATION, {}),
        ("drug_issue", schemas.DRUG_ISSUE, {}),
        ("inpatient_diagnosis", schemas.INPATIENT_DIAGNOSIS, {}),
        ("outpatient_clinical", schemas.OUTPATIENT_CLINICAL, {}),
        ("outpatient_appointment", schemas.OUTPATIENT_APPOINTMENT, {}),
        ("inpatient_episode", schemas.INPATIENT_EPISODE, {}),
        ("emergency_attendance", schemas.EMERGENCY_ATTENDANCE, {}),
        ("outpatient_visit", schemas.OUTPATIENT_VISIT, {}),
        ("procedure", schemas.INPATIENT_PROCEDURE, {}),
    )
}

#: Lists and lookups: folder -> what its files hold. The separator is told from each file's header, except where it is fixed.
LISTS = {
    "codelists": Source(schemas.MEDCODE_FILE, optional=("System",), separators=","),
    "icd": Source(schemas.ICD_FILE, optional=("OPCS4code", "Category"), separators=","),
    "drug_lists": Source(schemas.DRUG_LIST),
    "gemscript_map": Source(schemas.GEMSCRIPT_MAP, separators="|"),
    "products": Source(schemas.PRODUCT_DICTIONARY),
    "gp_ethnicity_lookup": Source(schemas.GP_ETHNICITY_LOOKUP),
    "hospital_ethnicity_lookup": Source(schemas.HOSPITAL_ETHNICITY_LOOKUP),
}


def listed(spark: SparkSession, root: str, name: str) -> DataFrame:
    if name == "drug_lists":
        return parsed(read_source(spark, f"{root}/{name}/{DRUG_LIST_GLOB}", LISTS[name], tag=DRUG_LIST_TAG))
    return parsed(read_source(spark, f"{root}/{name}", LISTS[name]))


def ingest(spark: SparkSession, root: str, name: str, keep: writers.Addressed) -> tuple[DataFrame, DataFrame, tuple[str, int, int]]:
    """An event table, its rejects, and (name, rows, rows with rejects). Text is read once: rejects are kept beside the parsed columns, and counted
    while the table is written; of a table that is there already, the short column of rejects is read."""
    read = read_source(spark, f"{root}/{name}", EVENTS[name])
    # the file is told where something did not parse, so the rejects are read from those parts of the table alone
    read = read.withColumn("file", F.when(F.size("rejected") > 0, F.col("file")))
    counts = F.count(F.lit(1)).alias("n"), F.count_if(F.size("rejected") > 0).alias("bad")
    if keep.has(read, f"raw/{name}"):
        kept = keep(read, f"raw/{name}")
        n, bad = kept.agg(*counts).first()
    else:
        seen = Observation()
        kept = keep(read, f"raw/{name}", lambda df: df.observe(seen, *counts))
        n, bad = seen.get["n"], seen.get["bad"]
    return parsed(kept), rejects(kept.where("file is not null")).select(F.lit(name).alias("table"), "*"), (name, n, bad)


def code_tables(spark: SparkSession, root: str, cfg: Config, keep: study.Keep) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Code list, ICD-10 lookup and products, from folders of lists.

    ``codelists`` and ``icd`` hold CSV files that may differ in their columns; ``drug_lists`` files named by list; ``disease_map``,
    ``gemscript_map`` and ``products`` a file each. Lists that are used more than once are kept.
    """
    disease_map = codelists.with_groups(readers.read_disease_map(spark, f"{root}/disease_map", cfg), cfg)
    built = codelists.build_codelist(codelists.load_codelist(listed(spark, root, "codelists")), disease_map)
    codelist = keep(codelists.set_durations(codelists.apply_description_rules(built), cfg), "codelist")
    lookup = codelists.icd_lookup(codelists.clean_icd(listed(spark, root, "icd"), cfg), disease_map, codelist, keep)
    drugs, gemscript, products = (listed(spark, root, n) for n in ("drug_lists", "gemscript_map", "products"))
    return codelist, lookup, codelists.build_prodcodes(drugs, gemscript, products, cfg)


def tables(spark: SparkSession, root: str, cfg: Config, keep: writers.Addressed) -> tuple[study.Tables, DataFrame, DataFrame]:
    """All input of a run, the rejects of all event tables, and rows and rows with rejects by table. Events go from text to Parquet once; the
    code tables are kept, as every step joins them."""
    read = {n: ingest(spark, root, n, keep) for n in EVENTS}
    codelist, lookup, products = code_tables(spark, root, cfg, keep)
    found = study.Tables(
        **{n: r[0] for n, r in read.items()},
        gp_ethnicity_lookup=listed(spark, root, "gp_ethnicity_lookup"),
        hospital_ethnicity_lookup=listed(spark, root, "hospital_ethnicity_lookup"),
        codelist=codelist,
        icd_lookup=keep(lookup, "icd_lookup"),
        prodcodes=keep(products.select("cond", F.col("prodcodeid")).distinct(), "prodcodes"),
    )
    bad = reduce(DataFrame.unionByName, [r[1] for r in read.values()])
    return found, bad, spark.createDataFrame([r[2] for r in read.values()], "table string, rows long, rejected long")


def run(spark: SparkSession, root: str, out: str, cfg: Config) -> DataFrame:
    """From raw files under ``root`` to tables under ``out``: interim tables by content (``writers.Addressed``), ``rejects`` and ``counts`` of the
    text read, and ``reports`` in order. Returns the panel. A run that broke off goes on with the tables that are there; one with other files or
    settings makes anew what depends on them."""
    keep = writers.Addressed(f"{out}/interim")
    t, bad, counts = tables(spark, root, cfg, keep)
    writers.write_table(bad, f"{out}/rejects")
    writers.write_table(counts, f"{out}/counts")
    keep(study.procedures(t, cfg), "procedures")
    panel = keep(study.study_panel(t, cfg, keep), "panel")
    writers.write_reports(study.study_reports(panel, cfg, keep), f"{out}/reports")
    return panel
