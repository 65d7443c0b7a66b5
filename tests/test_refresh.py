"""A panel that is brought up to date, a panel from bucketed tables, and a run from files under other settings."""

import re
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks import registry
from checks.adapters import CFG, Fixture
from morbidity.operators import joins
from morbidity.plans import from_files, refresh, study
from morbidity.sources import writers

SMALL = "/root/testdata/sf0.001"
N = 16


def bag(df):
    return Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def runs(spark, folder):
    return {r.bucket: r.run for r in refresh.newest(spark, folder)[1].collect()}


@pytest.fixture(scope="module")
def fixture(spark):
    """With its tables written, as a refresh reads each several times."""
    f = Fixture(spark, SMALL)
    for name in ("patient", "observation", "drug_issue", "inpatient", "op_clinical", "op_appointment"):
        setattr(f, name, writers.stage(getattr(f, name), name))
    return f


def test_refresh(spark, fixture, tmp_path):
    t, folder = fixture.tables, str(tmp_path / "panel")
    first = bag(refresh.refresh(t, CFG, folder, N))
    assert first == bag(study.study_panel(t, CFG)) and first
    before = runs(spark, folder)

    # the same rows in another order: nothing is made
    assert bag(refresh.refresh(replace(t, observation=t.observation.repartition(3, "obsid")), CFG, folder, N)) == first
    assert runs(spark, folder) == before

    # one patient's event more: one bucket
    patid = t.observation.join(study.eligible_patients(t, CFG), "patid", "left_semi").agg(F.min("patid")).first()[0]
    one = t.observation.where((F.col("patid") == patid) & F.col("obsdate").isNotNull()).limit(1)
    more = replace(t, observation=t.observation.unionByName(one.withColumn("medcodeid", F.lit(5).cast("long"))))
    changed = bag(refresh.refresh(more, CFG, folder, N))
    after = runs(spark, folder)
    bucket = spark.range(1).select(F.pmod(F.hash(F.lit(patid).cast("long")), F.lit(N))).first()[0]
    assert [b for b in after if after[b] != before.get(b)] == [bucket]
    assert changed == bag(study.study_panel(more, CFG))

    # a patient who is gone, and whose hospital person another registration takes over; buckets that are empty now
    fewer = replace(t, patient=t.patient.where((F.col("patid") != patid) & (F.pmod(F.hash("patid"), F.lit(N)) != 3)))
    assert bag(refresh.refresh(fewer, CFG, folder, N)) == bag(study.study_panel(fewer, CFG))

    # a setting, and a table without patients: all buckets
    other = replace(CFG, merge_spells=False)
    assert bag(refresh.refresh(fewer, other, folder, N)) == bag(study.study_panel(fewer, other))
    last = runs(spark, folder)
    refresh.refresh(replace(fewer, codelist=fewer.codelist.where("disease <> 'Asthma'")), other, folder, N)
    assert all(run != last[b] for b, run in runs(spark, folder).items())


def test_a_run_that_broke_off_changes_nothing(spark, fixture, tmp_path):
    t, folder = fixture.tables, str(tmp_path / "panel")
    first = bag(refresh.refresh(t, CFG, folder, 2))
    fewer = replace(t, observation=t.observation.where("patid % 2 = 0"))

    (tmp_path / "panel" / "lists" / "2" / "_temporary").mkdir(parents=True)
    assert bag(refresh.current(spark, folder)) == first
    assert bag(refresh.refresh(fewer, CFG, folder, 2)) == bag(study.study_panel(fewer, CFG))
    with pytest.raises(ValueError, match="no panel"):
        refresh.current(spark, str(tmp_path / "nothing"))


def by_patid(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*patid[^)]*)\)", df._jdf.queryExecution().executedPlan().toString())


def test_panel_from_tables_stored_by_patient(fixture):
    """No raw or coded event is moved by patient; what remains follows the unions of sources, whose rows are reduced by then."""
    plain = fixture.tables
    tables, keep = study.by_patient(plain, 4)
    patients = keep(study.eligible_patients(tables, CFG), "patients")
    coded = study.coded_events(tables, patients.hint("merge"), CFG)
    assert by_patid(study.coded_events(plain, patients.hint("merge"), CFG)) and not by_patid(coded)
    assert not by_patid(clean_only(tables, patients)) and by_patid(clean_only(plain, patients))
    observations = keep(coded, "observations")
    assert not by_patid(study.prescription_spells(tables, observations, patients, CFG))
    assert by_patid(study.prescription_spells(plain, observations, patients, CFG))
    out, usual = study.panel_of(tables, patients, CFG, keep), study.study_panel(plain, CFG)
    assert len(by_patid(out)) < len(by_patid(usual))
    assert bag(out) == bag(usual)


def clean_only(t, patients):
    """Raw events restricted to patients, by a sort-merge join."""
    return joins.restrict_to(t.drug_issue, patients.hint("merge"))


def test_rejects_name_their_file_and_lists_are_read_once(spark, tmp_path, rows):
    f = Fixture(spark, SMALL)
    registry.write_raw_files(f, str(tmp_path / "files"))
    with open(tmp_path / "files" / "deprivation" / "more.csv", "w") as more:
        more.write("patid\timd2015_10\n1\tten\n2\t3\n")
    keep = writers.Addressed(str(tmp_path / "kept"))
    kept, bad, counted = from_files.ingest(spark, str(tmp_path / "files"), "deprivation", keep)
    found = [(r.table, r.file.split("/")[-1], r.column, r.value) for r in bad.collect()]
    assert found == [("deprivation", "more.csv", "imd2015_decile", "ten")] and counted[2] == 1
    assert spark.read.parquet(str(tmp_path / "kept/raw/deprivation/*")).where("file is not null").count() == 1
    codes, lookup, _ = from_files.code_tables(spark, str(tmp_path / "files"), CFG, keep)
    assert all("/kept/" in x for x in [*codes.inputFiles(), *lookup.inputFiles()])


def test_a_run_from_files_under_other_settings(spark, tmp_path):
    f = Fixture(spark, SMALL)
    root, out = str(tmp_path / "files"), tmp_path / "out"
    registry.write_raw_files(f, root)
    with open(tmp_path / "files" / "drug_issue" / "late.csv", "w") as late:
        late.write("e_issuedate\tnote\tE_PRODCODEID\tpatid\n31/02/1999\t\t12\t1\nnone\t\tx1\t2\n01/02/1999\t\t12\t3\n")
    first = bag(from_files.run(spark, root, str(out), CFG))

    def made():
        return {p.relative_to(out / "interim").as_posix() for p in (out / "interim").glob("**/_SUCCESS")}

    before = made()
    assert bag(from_files.run(spark, root, str(out), CFG)) == first and made() == before
    bad = spark.read.parquet(str(out / "rejects"))
    assert sorted((r["table"], r.column, r.value) for r in bad.collect()) == [
        ("drug_issue", "issuedate", "31/02/1999"), ("drug_issue", "issuedate", "none"), ("drug_issue", "prodcodeid", "x1")]
    counts = {r["table"]: (r.rows, r.rejected) for r in spark.read.parquet(str(out / "counts")).collect()}
    assert counts["drug_issue"] == (f.drug_issue.count() + 3, 2) and counts["patient"][1] == 0
    from_files.run(spark, root, str(out), replace(CFG, merge_days=10))
    names = {p.split("/")[0] for p in made() - before}
    assert "panel" in names and not names & {"raw", "codelist", "icd_lookup", "prodcodes", "patients", "observations", "hospital"}
    for family in ("score", "prevalence"):
        whole = spark.read.parquet(str(out / "reports" / family))
        for report in {r.report for r in whole.select("report").distinct().collect()}:
            keys = [tuple(-1 if x is None else x for x in r) for r in writers.read_report(spark, str(out / "reports"), family, report).select(*writers.REPORT_ORDER).collect()]
            assert keys == sorted(keys) and keys


def test_prints_add_longs(spark, fixture):
    """Sums of hashes are sums of longs, not of decimals, and are the same in any order and however rows are dealt."""
    df = fixture.tables.observation
    sums = df.agg(refresh._sum(df).alias("s"))
    assert "decimal" not in sums._jdf.queryExecution().optimizedPlan().toString().lower()
    dealt = df.repartition(7, "obsid")
    assert sums.first() == dealt.agg(refresh._sum(dealt).alias("s")).first()
    twice = df.unionByName(df.limit(2))
    assert sums.first() != twice.agg(refresh._sum(twice).alias("s")).first()


def test_buckets_by_patient_keep_all_cores_busy(spark, fixture):
    """Two buckets for each core at least, up to a shuffle's partitions, whatever number is asked for."""
    tables, _ = study.by_patient(fixture.tables, 1)
    read = tables.observation.groupBy("patid").count()._jdf.queryExecution().executedPlan().toString()
    n = min(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    assert f"SelectedBucketsCount: {n} out of {n}" in read
