"""Every registered query against its SQL, the shape of the plans, and what must hold on any panel."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from checks.adapters import CFG, Fixture
from checks.compare import compare, connect
from checks.oracle import FINAL
from checks.registry import QUERIES, whole_panel
from morbidity.operators import spells, standardise
from morbidity.plans import study
from morbidity.sources.writers import stage

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(FINAL)


@pytest.mark.parametrize("name", list(FINAL))
def test_query_matches_its_sql(spark, con, name):
    assert compare(spark, con, SMALL, name) in (None, "no rows")


@pytest.mark.parametrize("name", ["clean_birth_year", "permanent_dx", "spell_source", "rx_spells", "panel_final",
                                  "score_standardised", "prev_crude", "icd_lookup", "active_set"])
def test_plan_shape(spark, name):
    """No Python in the plan, no product of two tables, no exchange into one task."""
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|ArrowEval|CartesianProduct|BroadcastNestedLoop|Exchange SinglePartition", plan)


@pytest.fixture(scope="module")
def panel_df(spark):
    return stage(whole_panel(Fixture(spark, SMALL)), "panel")


def test_panel_invariants(panel_df):
    assert panel_df.count() == panel_df.select("patid", "fyear").distinct().count() > 0
    low = F.least(*[F.col(f"prop_{c}") for c in CFG.condition_columns])
    high = F.greatest(*[F.col(f"prop_{c}") for c in CFG.condition_columns])
    assert panel_df.where((low < 0) | (high > F.col("weight") + 1e-9) | (F.col("weight") > 1)).count() == 0
    assert panel_df.where(low.isNull()).count() == 0


def test_spells_do_not_touch(spark):
    found = QUERIES["spell_source"](spark, SMALL).collect()
    by = {}
    for r in sorted(found, key=lambda r: (r.patid, r.list_disease_real, r.diag_date)):
        before = by.get((r.patid, r.list_disease_real))
        assert before is None or (r.diag_date - before.diag_date).days >= 365
        by[r.patid, r.list_disease_real] = r
    assert found


def test_cells_add_up(panel_df):
    cells = standardise.report_cells(study.reported_rows(panel_df, CFG), CFG).collect()
    for year in {c.fyear for c in cells}:
        mine = [c for c in cells if c.fyear == year]
        assert sum(c.popsize for c in mine) == mine[0].popsize_tot
        assert sum(c.standard_pop_wt for c in mine if c.wt_esp) == pytest.approx(1)


def test_rules_can_be_switched_off(spark):
    f = Fixture(spark, SMALL)
    off = replace(CFG, remove_duplicate_practices=False, remove_linked_duplicates=False, clean_observations=False,
                  clean_episodes=False, use_prescriptions=False, merge_spells=False, keep_death=False)
    more = study.eligible_patients(f.tables, off).count()
    assert more > study.eligible_patients(f.tables, CFG).count()
    panel_off = study.study_panel(f.tables, off)
    assert panel_off.where("prop_pain > 0 or prop_constipation > 0").count() == 0 and panel_off.count() > 0


def test_reports_are_the_same_to_the_last_bit(panel_df):
    """However the panel is dealt, and from the states of halves and thirds as from the whole."""

    def bits(found):
        return {k: sorted(map(repr, df.collect())) for k, df in found.items()}

    def states(df):
        return standardise.cell_states(study.reported_rows(df, CFG), CFG)

    want = bits(study.study_reports(panel_df, CFG))
    for n in (3, 8, 200):
        assert bits(study.merged_reports([states(panel_df.repartition(n, F.rand(n)))], CFG)) == want
    for n in (2, 3):
        assert bits(study.merged_reports([states(panel_df.where(F.col("patid") % n == k)) for k in range(n)], CFG)) == want


def test_reports_come_from_the_panel_given(panel_df):
    out = study.study_reports(panel_df, CFG)
    assert out["score"].inputFiles() and not set(out["score"].inputFiles()) & set(panel_df.inputFiles())  # from its cells
    cells = standardise.report_cells(study.reported_rows(panel_df, CFG), CFG)
    assert set(cells.inputFiles()) == set(panel_df.inputFiles())  # one scan, of the panel
    assert cells._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert out["score"].select("report").distinct().count() == 11
    assert out["prevalence"].select("report").distinct().count() == 11
    assert spells.KEYS == ("patid", "list_disease_real")
