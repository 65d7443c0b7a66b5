import random
from collections import defaultdict
from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from morbidity.config import SCORE_WEIGHTS, Config, column_name
from morbidity.operators import panel, reports, score, standardise

CFG = Config()
PEOPLE = "patid long, regstartdate date, censor_date date, death_date date, yob int"


def test_skeleton_years_and_weights(make, rows):
    p = make(PEOPLE, [
        (1, "2018-10-01", "2020-09-30", None, 1950),
        (2, "2000-01-01", "2009-03-31", "2012-06-01", 1950),  # dies years after censoring
        (3, "2019-05-01", "2019-12-31", "2019-12-31", 1950),
        (4, "2019-05-01", "2019-12-31", "2020-01-31", 1950),  # dies in the year of censoring
        (5, "1990-01-01", "2005-01-01", "2008-01-01", 1950),  # only the death is in the study
        (6, "1990-01-01", "2005-01-01", None, 1950),
    ])
    out = panel.with_weight(panel.panel_skeleton(p, CFG))
    got = {(r.patid, r.fyear): (r.death, r.weight) for r in out.collect()}
    assert got[1, 2018] == (0, 182 / 365) and got[1, 2019] == (0, 1.0) and got[1, 2020] == (0, 183 / 365)
    assert {y for i, y in got if i == 2} == {2007, 2008, 2012}
    assert got[2, 2007] == (0, 1.0) and got[2, 2012] == (1, 0.0)
    assert got[3, 2019] == (1, 245 / 366) and got[4, 2019] == (1, 245 / 366)
    assert {k for k in got if k[0] == 5} == {(5, 2007)} and got[5, 2007] == (1, 0.0)
    assert not [k for k in got if k[0] == 6]
    alone = panel.panel_skeleton(p, replace(CFG, keep_death=False))
    assert {r.fyear for r in alone.where("patid = 2").collect()} == {2007, 2008}


def _in_force(spells, first, last):
    """Year by year: the latest year with a diagnosis up to now, its earliest diagnosis."""
    out = {}
    by = defaultdict(list)
    for p, c, d, r in spells:
        if r >= date(2007, 4, 1):
            by[p, c].append((d.year - (d.month < 4), d, r))
    for (p, c), seen in by.items():
        for y in range(first, last + 1):
            past = [s for s in seen if s[0] <= y]
            if past:
                newest = max(s[0] for s in past)
                out[p, c, y] = min((d, r) for since, d, r in past if since == newest)
    return out


def test_roll_forward_against_the_definition(make):
    rng = random.Random(4)
    spells = []
    for _ in range(300):
        d = date(1995, 1, 1) + timedelta(rng.randint(0, 9500))
        spells.append((rng.randint(1, 15), rng.choice(["Asthma", "Pain"]), d, d + timedelta(rng.randint(100, 5000))))
    df = make("patid long, list_disease_real string, diag_date date, remission_date date", spells)
    out = {(r.patid, r.list_disease_real, r.fyear): (r.diag_date, r.remission_date)
           for r in panel.rolled_spells(df, CFG).collect()}
    assert out == _in_force(spells, 2007, 2020)


def test_panel_rows(make):
    p = make(PEOPLE + ", pracid int, gender int, region int, imd2015_decile int, ethnicity string",
             [(1, "2000-01-01", "2021-03-31", None, 1950, 1, 1, 1, 3, None),
              (2, "2010-06-01", "2021-03-31", None, 1950, 1, 1, 1, 3, "x")])
    permanent = make("patid long, list_disease_real string, diag_date date",
                     [(1, "COPD", "2010-10-01"), (2, "COPD", "2011-05-01")])
    spells = make("patid long, list_disease_real string, diag_date date, remission_date date",
                  [(1, "Asthma", "2008-10-01", "2010-03-31"), (1, "Asthma", "2015-04-01", "2015-04-01")])
    out = panel.assemble_panel(p, permanent, spells, CFG)
    assert len([c for c in out.columns if c.startswith("prop_")]) == 35
    got = {(r.patid, r.fyear): r for r in out.collect()}
    assert len(got) == 14 + 11
    assert got[1, 2009].prop_copd == 0 and got[1, 2010].prop_copd == 182 / 365 and got[1, 2020].prop_copd == 1
    assert got[1, 2010].inc_copd == 1 and got[1, 2011].inc_copd == 0
    assert got[2, 2011].inc_copd == 0  # within the first year of registration
    assert [got[1, y].prop_asthma for y in (2007, 2008, 2009, 2010)] == [0, 182 / 365, 364 / 365, 0]
    assert got[1, 2015].prop_asthma == 0 and got[1, 2015].inc_asthma == 1
    assert all(got[k].prop_pain == 0 for k in got)


def test_score(make):
    names = [column_name(c) for c in CFG.conditions]
    schema = "patid long, " + ", ".join(f"prop_{n} double" for n in names)
    df = make(schema, [(1, *[1.0] * 35), (2, *[None if n == "pain" else 1.0 for n in names])])
    out = {r.patid: r for r in score.with_score(df, CFG).collect()}
    assert out[1].cam_score_general == pytest.approx(sum(SCORE_WEIGHTS.values())) and out[2].cam_score_general is None
    assert "prop_anxiety" not in out[1].asDict() and "prop_all_cancers" in out[1].asDict()


def test_standard_population(spark):
    df = standardise.standard_population(spark, CFG)
    assert df.count() == 5460
    sums = df.groupBy("gender", "imd_deciles", "fyear").agg(F.sum("wt_esp").alias("s")).select("s").distinct().collect()
    assert [r.s for r in sums] == [100_000.0]


def _panel(make):
    rng = random.Random(2)
    names = CFG.reported_columns
    schema = ("patid long, fyear int, yob int, gender int, imd2015_decile int, weight double, cam_score_general double, "
              + ", ".join(f"prop_{n} double" for n in names))
    made = []
    for i in range(400):
        yob, g = rng.randint(1905, 1985), rng.randint(1, 2)
        dec = rng.choice([None, 1, 5, 10])
        for y in (2008, 2009, 2019, 2020):
            made.append((i, y, yob, g, dec, rng.choice([0.0, 0.5, 1.0]), rng.random() * 3,
                         *[rng.choice([0.0, 0.0, 0.7]) for _ in names]))
    return make(schema, made), made


def _cells(made):
    """Cells and their members, one row at a time."""
    cells = defaultdict(list)
    for r in made:
        age = r[1] - r[2]
        if r[1] in (2008, 2009, 2019) and 30 <= age <= 99 and r[5] != 0:
            cells[r[1], min(age, 99) // 5, r[3], r[4]].append(r)
    return cells


def test_cells_and_reports(spark, make):
    df, made = _panel(make)
    active = standardise.active_rows(df, standardise.standard_population(spark, CFG), CFG)
    cells = _cells(made)
    year = {y: sum(len(v) for k, v in cells.items() if k[0] == y) for y in (2008, 2009, 2019)}
    got = standardise.report_cells(active, CFG).collect()
    assert len(got) == len(cells) and {r.fyear: r.popsize_tot for r in got} == year
    for r in got:
        members = cells[r.fyear, int(r.agecat.split("-")[0]) // 5, r.gender, r.imd2015_decile]
        assert r.popsize == len(members)
        assert r.cam_score_general == pytest.approx(sum(m[6] for m in members) / len(members))
        assert (r.wt_esp is None) == (r.imd2015_decile is None)
    sized = standardise.active_set(active)
    assert {(r.fyear, r.popsize_tot) for r in sized.collect()} == set(year.items()) and sized.count() == active.count()

    prev = standardise.report_cells(active, CFG)
    report = reports.weighted_report(prev, ["prev_copd"], "actual_pop_wt", {"a": (), "b": ("gender",)})
    col = 7 + CFG.reported_columns.index("copd")
    for r in report.collect():
        members = [m for k, v in cells.items() if k[0] == r.fyear and r.gender in (None, k[2]) for m in v]
        assert r.prev_copd == pytest.approx(sum(m[col] > 0 for m in members) / len(members))

    standard = reports.weighted_report(standardise.report_cells(active, CFG), ["cam_score_general"], "standard_pop_wt", {"a": ()})
    for r in standard.collect():
        picked = [c for c in got if c.fyear == r.fyear and c.wt_esp is not None]
        want = sum(c.cam_score_general * c.wt_esp for c in picked) / sum(c.wt_esp for c in picked)
        assert r.cam_score_general == pytest.approx(want)

    strict = replace(CFG, strict=True)
    nulled = reports.weighted_report(standardise.report_cells(active, strict), ["cam_score_general"], "standard_pop_wt", {"a": ()}, strict=True)
    assert [r.cam_score_general for r in nulled.collect()] == [None] * 3


def test_report_names_and_keys(make):
    cells = make("fyear int, agecat string, agecat_ord int, gender int, imd_deciles string, imd2015_decile int, x double, w double",
                 [(2008, "30-34", 8, 1, "2", 2, 1.0, 1.0), (2008, "30-34", 8, 2, None, None, 3.0, 3.0), (2008, "35-39", 9, 2, "2", 2, None, 9.0)])
    names = {"year": (), "imd": ("imd_deciles", "imd2015_decile"), "age_sex": ("agecat", "gender")}
    out = reports.in_order(reports.weighted_report(cells, ["x"], "w", names)).collect()
    assert [(r.report, r.agecat, r.gender, r.imd_deciles, r.x) for r in out] == [
        ("age_sex", "30-34", 1, None, 1.0), ("age_sex", "30-34", 2, None, 3.0), ("age_sex", "35-39", 2, None, None),
        ("imd", None, None, None, 3.0), ("imd", None, None, "2", 1.0), ("year", None, None, None, 2.5)]


def test_names_that_need_care(spark, make):
    """Quotes and hyphens in a condition's name reach neither SQL text nor a column's name."""
    cfg = replace(CFG, conditions=("Crohn's", "Non-organic pain", "Asthma"), resolving=("Non-organic pain",))
    assert cfg.condition_columns == ("crohn_s", "non_organic_pain", "asthma")
    found = make("patid long, list_disease_real string, diag_date date", [(1, "Crohn's", "2010-05-01"), (1, "Crohn's", "2009-05-01")])
    row = panel.permanent_wide(found, cfg).first()
    assert row.crohn_s.isoformat() == "2009-05-01" and row.asthma is None
    spells = make("patid long, list_disease_real string, diag_date date, remission_date date", [(1, "Non-organic pain", "2010-05-01", "2011-05-01")])
    assert panel.resolving_wide(spells, cfg).first().in_force[2010].rem_non_organic_pain.isoformat() == "2011-05-01"
