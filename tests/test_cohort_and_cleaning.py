from datetime import date

from morbidity.config import Config
from morbidity.operators import clean, cohort, demographics

CFG = Config()
PATIENT = "patid long, pracid int, regstartdate date, regenddate date"


def test_duplicate_practices(make, rows):
    df = make("patid long, pracid int", [(1, 20023), (2, 1)])
    assert rows(cohort.drop_duplicate_practices(df, CFG)) == [(2, 1)]


def test_one_registration_per_person(make, rows):
    p = make(PATIENT, [
        (1, 1, "2001-01-01", "2005-01-01"), (2, 1, "2002-01-01", None), (3, 1, "2002-01-01", "2003-01-01"),
        (4, 1, "2000-01-01", None), (5, 1, "2000-01-01", None), (6, 1, "1999-01-01", None)])
    links = make("patid long, gen_hesid long", [(1, 9), (2, 9), (3, 9), (4, 8), (5, 8), (6, None)])
    assert [r[0] for r in rows(cohort.dedupe_linked(p, links))] == [3, 5, 6]


def test_death_date(make, rows):
    p = make("patid long, cprd_ddate date", [(1, "2020-01-01"), (2, "2019-10-31"), (3, "2019-11-01"), (4, None)])
    register = make("patid long, dod date, match_rank int",
                    [(1, "2018-05-05", 3), (1, "2018-06-06", 1), (1, "2017-01-01", None)])
    out = rows(cohort.with_death_date(p, register, CFG), "patid", "death_date")
    assert out == [(1, "2018-06-06"), (2, None), (3, "2019-11-01"), (4, None)]


def test_practice_and_censoring(make, rows):
    p = make("patid long, pracid int, regstartdate date, regenddate date, death_date date", [
        (1, 20538, "2010-01-01", None, "2015-05-05"), (2, 2, "2010-01-01", "2012-01-01", "2013-01-01"),
        (3, 2, "2019-06-01", None, None), (4, 99, "2010-01-01", None, None)])
    prac = make("pracid int, region int, lcd date", [(20538, 7, "2021-01-01"), (2, 3, "2019-06-01")])
    out = cohort.with_censor_date(cohort.with_practice(p, prac, CFG), CFG)
    assert rows(out, "patid", "region", "regenddate", "censor_date") == [
        (1, 2, "2015-05-05", "2015-05-05"), (2, 3, "2012-01-01", "2012-01-01"), (3, 3, None, "2019-06-01"),
        (4, None, None, "2021-03-31")]
    assert [r[0] for r in rows(cohort.valid_follow_up(out), "patid")] == [1, 2, 4]


def test_buckets_are_stable_and_whole(spark):
    df = cohort.with_bucket(spark.range(1000).withColumnRenamed("id", "patid"), 16)
    again = cohort.with_bucket(spark.range(1000).repartition(3).withColumnRenamed("id", "patid"), 16)
    assert sorted(df.collect()) == sorted(again.collect()) and df.where("bucket between 0 and 15").count() == 1000


def test_observation_dates(make, rows):
    obs = make("id int, obsdate date, enterdate date", [
        (1, None, "2010-01-01"), (2, "1899-12-31", "2010-01-01"), (3, "1899-12-31", None), (4, "2023-01-02", "2023-01-02"),
        (5, "1900-01-01", None), (6, "2023-01-01", "1800-01-01"), (7, None, None), (8, None, "1850-01-01")])
    assert rows(clean.clean_observation_dates(obs, CFG), "id", "obsdate") == [
        (1, "2010-01-01"), (2, "2010-01-01"), (5, "1900-01-01"), (6, "2023-01-01")]


def test_birth_year(make, rows):
    obs = make("patid long, id int, obsdate date, enterdate date", [
        (1, 1, "1979-12-31", "1985-01-01"), (1, 2, "1979-12-31", "1979-12-31"), (1, 3, "1980-01-01", None),
        (1, 4, "1979-01-01", None), (2, 5, "1990-01-01", "1990-01-01"), (9, 6, "1990-01-01", "1990-01-01")])
    people = make("patid long, yob int", [(1, 1980), (2, None)])
    assert rows(clean.clean_birth_year(obs, people), "id", "obsdate", "yob") == [
        (1, "1985-01-01", 1980), (3, "1980-01-01", 1980)]


def test_fill_date_and_outpatients(make, rows):
    df = make("a date, b date", [(None, "2001-01-01"), ("2002-02-02", None)])
    assert rows(clean.fill_date(df, "a", "b"), "a") == [("2001-01-01",), ("2002-02-02",)]
    c = make("patid long, attendkey long, diag_01 string", [(1, 7, "I10"), (1, 8, "E11"), (2, 7, "F10")])
    a = make("patid long, attendkey long, apptdate date", [(1, 7, "2001-01-01"), (2, 8, "2001-01-01")])
    assert rows(clean.outpatient_diagnoses(c, a), "patid", "diag_01", "apptdate") == [(1, "I10", "2001-01-01")]


def test_modal_value(make, rows):
    df = make("k int, v string, d date", [
        (1, "a", "2001-01-01"), (1, "a", "2001-01-02"), (1, "b", "2010-01-01"),  # most frequent
        (2, "a", "2001-01-01"), (2, "b", "2002-01-01"),  # tie: most recent
        (3, "b", "2001-01-01"), (3, "a", "2001-01-01"),  # still tied: by name
        (4, "a", None), (4, "b", None),  # tie without dates: left out
        (5, "a", None),  # no tie, date not needed
        (6, "a", "2009-01-01"), (6, "a", None), (6, "b", "2001-01-01"), (6, "b", "2001-01-01")])  # undated loses
    assert rows(demographics.modal_value(df, "k", "v", "d")) == [(1, "a"), (2, "b"), (3, "a"), (5, "a"), (6, "b")]


def test_ethnicity_sources(make, rows):
    groups = make("HES_ethnic_group string, HES_category string",
                  [("White", "W"), ("Indian", "A"), ("Pakistani", "A"), ("Unknown", "U")])
    epi = make("patid long, admidate date, ethnos string", [(1, "2001-01-01", "White"), (1, "2001-01-01", "White")])
    att = make("patid long, arrivaldate date, ethnos string", [(1, "2001-01-01", "Unknown"), (1, "2001-01-01", "Other")])
    op = make("patid long, apptdate date, ethnos string", [(2, "2001-01-01", "Indian")])
    assert rows(demographics.hospital_ethnicity(epi, att, op, groups)) == [
        (1, "2001-01-01", "White", "W", "HES"), (2, "2001-01-01", "Indian", "A", "HES")]
    obs = make("patid long, medcodeid long, obsdate date, obstypeid int",
               [(1, 5, "2001-01-01", 1), (1, 6, "2001-01-01", 1), (1, 5, "2001-01-01", 4), (2, 5, "2001-01-01", None)])
    codes = make("medcodeid long, Term string, Group1 string, Group2 string, Group3 string",
                 [(5, "t", "x", "A", "z"), (6, "u", "y", "A", "z")])
    assert rows(demographics.gp_ethnicity(obs, codes, groups, CFG)) == [
        (1, "2001-01-01", "Indian", "A", "CPRD"), (1, "2001-01-01", "Pakistani", "A", "CPRD")]


def test_patient_table(make, rows):
    p = make("patid long, yob int", [(1, 1950), (2, 1960)])
    imd = make("patid long, imd2015_decile int", [(1, 4)])
    eth = make("patid long, HES_ethnic_group string", [(2, "White")])
    assert rows(demographics.patient_table(p, imd, eth)) == [(1, 1950, 4, None)]
    assert CFG.end == date(2021, 3, 31)
