import random
from collections import defaultdict
from dataclasses import replace
from datetime import date, timedelta

from morbidity.config import Config
from morbidity.sources import schemas
from morbidity.operators import diagnosis, prescriptions, spells

CFG = Config()
ICD = "ICD10code string, list_disease_real string, disease_duration int"
GP = "patid long, medcodeid long, obsdate date"
CODES = "disease string, medcodeid long, read int, list_disease_real string, descr string"
HOSPITAL = "patid long, obsdate date, list_disease_real string, disease_duration int, source string, remission_date date"
EVENT = "patid long, list_disease_real string, obsdate date, disease_duration int, source string"
D0 = date(2000, 1, 1)


def day(n):
    return D0 + timedelta(n)


def test_inpatient(make, rows):
    diag = make("patid long, epistart string, icd string",
                [(1, "05/04/2010", "J45"), (1, "05/04/2010", "J45"), (1, "05/04/2010", "I10"), (1, "bad", "I10"), (2, "01/01/2010", None)])
    look = make(ICD, [("J45", "Asthma", 365), ("I10", "Hypertension", 9999999), (None, "Pain", 365)])
    assert rows(diagnosis.inpatient_dx(diag, look, CFG)) == sorted([
        (1, "2010-04-05", "Asthma", 365, "HES", "2011-04-05"), (1, "2010-04-05", "Hypertension", 9999999, "HES", "2021-03-31"),
        (1, None, "Hypertension", 9999999, "HES", "2021-03-31")], key=repr)


def test_outpatient(make, rows):
    op = make("patid long, attendkey long, diag_01 string, diag_02 string, diag_03 string",
              [(1, 1, "I10X", "", None), (1, 2, "I10", "E119", "I10.0"), (1, 3, "E119", None, None), (2, 1, "E119", None, None)])
    seen = make(schemas.OUTPATIENT_APPOINTMENT, [(1, 1, "01/01/2010"), (1, 2, "01/01/2010"), (2, 2, "x")])
    look = make(ICD, [("I10", "Hypertension", 9999999), ("I10.0", "Hypertension", 9999999), ("E11.9", "Diabetes", 9999999)])
    assert len(rows(diagnosis.outpatient_codes(op, CFG))) == 6
    assert rows(diagnosis.outpatient_dx(op, seen, look, CFG), "obsdate", "list_disease_real") == [
        ("2010-01-01", "Diabetes"), ("2010-01-01", "Hypertension")]
    fixed = diagnosis.outpatient_codes(op, replace(CFG, fix_icd=True))
    assert rows(fixed, "ICD10code") == [("E11.9",)] * 3 + [("I10",), ("I10",), ("I10.0",)]


def test_hospital_and_gp(make, rows):
    a = make(HOSPITAL, [(1, "2010-01-01", "COPD", 9, "HES", None), (1, "2022-01-01", "COPD", 9, "HES", None), (2, "2010-01-01", "COPD", 9, "HES", None)])
    b = make(HOSPITAL, [(1, "2010-01-01", "COPD", 9, "HES", None)])
    people = make("patid long", [(1,)])
    assert len(rows(diagnosis.hospital_dx(a, b, people, CFG))) == 1
    obs = make("patid long, medcodeid long, obsdate date, obstypeid int",
               [(1, 5, "2010-01-01", 1), (1, 5, "2010-01-01", 2), (1, 5, "2010-01-01", 4), (1, 5, "2010-01-02", None),
                (1, 6, "2010-01-01", 1), (1, 5, "2021-04-01", 1)])
    codes = make(CODES, [("d", 5, 1, "COPD", "x"), ("d", 5, 1, "Asthma", "x")])
    assert rows(diagnosis.gp_dx(obs, codes, CFG)) == [(1, 5, "2010-01-01")]


def test_permanent(make, rows):
    gp = make(GP, [(1, 5, "2010-01-01"), (1, 5, "2009-01-01"), (2, 5, "2010-01-01"), (3, 6, "2010-01-01"), (5, 5, "2021-03-31")])
    hosp = make(HOSPITAL, [
        (1, "2009-01-01", "COPD", 9999999, "HES", None), (2, "2009-12-31", "COPD", 9999999, "HES", None),
        (4, "2001-01-01", "COPD", 9999999, "HES", None), (4, "2001-01-01", "Asthma", 365, "HES", None)])
    codes = make(CODES, [("d", 5, 9999999, "COPD", "x"), ("d", 6, 365, "Epilepsy", "x"), ("d", 5, 365, "Asthma", "x")])
    assert rows(diagnosis.permanent_dx(gp, hosp, codes, CFG)) == [
        (1, "COPD", "2009-01-01", "CPRD", "2021-03-31"), (2, "COPD", "2009-12-31", "HES", "2021-03-31"),
        (4, "COPD", "2001-01-01", "HES", "2021-03-31"), (5, "COPD", "2021-03-31", "CPRD", "2021-03-31")]


def test_resolving_events(make, rows):
    gp = make(GP, [(1, 5, "2010-01-01"), (1, 6, "2010-01-01")])
    hosp = make(HOSPITAL, [(1, "2010-01-01", "Asthma", 365, "HES", None), (1, "2010-01-01", "COPD", 9, "HES", None)])
    codes = make(CODES, [("d", 5, 365, "Asthma", "x"), ("d", 6, 365, "Asthma", "x"), ("d", 6, 9, "COPD", "x")])
    assert rows(diagnosis.resolving_events(gp, hosp, codes, CFG)) == [
        (1, "Asthma", "2010-01-01", 365, "HES"), (1, "Asthma", "2010-01-01", 366, "CPRD")]


def test_gap_exactly_the_duration(make, rows):
    ev = make(EVENT, [(1, "Asthma", day(0), 365, "HES"), (1, "Asthma", day(365), 365, "HES"), (1, "Asthma", day(731), 365, "HES")])
    assert rows(spells.gap_spells(ev), "diag_date", "remission_date") == [
        ("2000-01-01", (day(365) + timedelta(365)).isoformat()), (day(731).isoformat(), (day(731) + timedelta(365)).isoformat())]


def _random_events(seed, n, conditions):
    rng = random.Random(seed)
    made = set()
    for _ in range(n):
        c = rng.choice(conditions)
        gp = rng.random() < 0.6
        made.add((rng.randint(1, 12), c, day(rng.randint(0, 7000)), (366 if gp else 365), "CPRD" if gp else "HES"))
    return sorted(made)


def _by_key(events):
    groups = defaultdict(list)
    for p, c, d, dur, src in events:
        groups[p, c].append((d, src, dur))
    return {k: sorted(v) for k, v in groups.items()}


def _spells_one_by_one(events, cfg):
    """The definition, event by event."""
    out, cancers = set(), defaultdict(list)
    for (p, c), evs in _by_key(events).items():
        if c in cfg.single_cancers:
            d, src, dur = evs[0]
            out.add((p, c, d, d + timedelta(3653), dur, src))
            cancers[p].append((c, d, dur, src))
            continue
        if c not in cfg.resolving_non_cancer:
            continue
        current = []
        for e in evs + [None]:
            if current and (e is None or (e[0] - current[-1][0]).days > e[2]):
                d, src, dur = current[0]
                out.add((p, c, d, current[-1][0] + timedelta(dur), dur, src))
                current = []
            current.append(e)
    for p, found in cancers.items():
        c, d, dur, src = min(found)
        dates = [f[1] for f in found]
        out.add((p, "All cancers", min(dates), max(dates) + timedelta(3653), dur, src))
    return out


def test_spells_against_the_definition(make):
    conditions = ["Asthma", "Depression", "Lung cancer", "Breast cancer", "All cancers", "Pain"]
    events = _random_events(3, 700, conditions)
    df = make(EVENT, events)
    want = _spells_one_by_one(events, CFG)
    assert {tuple(r) for r in spells.resolving_spells(df, CFG).collect()} == want
    parts = spells.first_cancer_spells(df, CFG)
    other = spells.gap_spells(df.where(df.list_disease_real.isin(*CFG.resolving_non_cancer))).select(*spells.SPELL)
    split = other.unionByName(parts).unionByName(spells.all_cancer_spell(parts, CFG))
    assert {tuple(r) for r in split.collect()} == want
    # the same from shuffled, differently partitioned rows
    assert {tuple(r) for r in spells.resolving_spells(df.repartition(7), CFG).collect()} == want


SPELLS = "patid long, list_disease_real string, diag_date date, remission_date date, source string"


def test_merging_close_spells(make, rows):
    s = make(SPELLS, [
        (1, "Asthma", "2000-01-01", "2000-02-01", "HES"), (1, "Asthma", "2001-01-30", "2001-03-01", "CPRD"),  # 364 days
        (1, "Asthma", "2002-03-01", "2002-04-01", "CPRD"),  # exactly 365
        (2, "Pain", "2000-01-01", "2003-01-01", "HES"), (2, "Pain", "2000-02-01", "2000-03-01", "HES"),
        (2, "Pain", "2001-03-01", "2001-04-01", "HES")])  # 365 after the remission of the row before, though inside the first
    merged = spells.merge_close_spells(s, 365)
    assert rows(merged) == [
        (1, "Asthma", "2000-01-01", "2001-03-01", "CPRD"), (1, "Asthma", "2000-01-01", "2001-03-01", "HES"),
        (1, "Asthma", "2002-03-01", "2002-04-01", "CPRD"), (2, "Pain", "2000-01-01", "2003-01-01", "HES"),
        (2, "Pain", "2001-03-01", "2001-04-01", "HES")]
    assert rows(spells.merge_sources(merged), "patid", "diag_date", "source") == [
        (1, "2000-01-01", "Both HES and CPRD"), (1, "2002-03-01", "CPRD"), (2, "2000-01-01", "HES"), (2, "2001-03-01", "HES")]


def test_three_sources_become_null(make, rows):
    s = make(SPELLS, [(1, "Pain", "2000-01-01", "2000-02-01", x) for x in ("A", "B", "C")])
    assert rows(spells.merge_sources(s), "source") == [(None,)]


RX = "patid long, prodcodeid long, issuedate date"


def test_four_issues_in_a_year(make, rows):
    prods = make("prodcodeid long, cond string", [(1, "CON150"), (2, "CON150")])
    # 365 days from first to fourth for patient 1, 366 for patient 2; patient 3 reaches four only with a repeat
    drugs = make(RX, [(1, 1, day(x)) for x in (0, 10, 20, 365)] + [(2, 1, day(x)) for x in (0, 10, 20, 366)]
                 + [(3, 1, day(x)) for x in (0, 0, 10, 20)] + [(4, 1, day(x)) for x in (0, 10, 20)])
    rx = prescriptions.rx_candidates(drugs, prods, CFG)
    assert {r.patid for r in rx.collect()} == {1, 2, 3} and rx.where("patid = 3").count() == 3
    out = prescriptions.rx_spells(prescriptions.rx_flag(rx, CFG), CFG)
    assert rows(out) == [(1, "Constipation", "2000-01-01", "2000-12-31", 365, "CPRD")]


def _rx_one_by_one(rx, epilepsy):
    """The definition: flags per list, the exclusion, then runs of equal flags over interleaved lists."""
    flagged = []
    groups = defaultdict(list)
    for p, c, d, k in rx:
        groups[p, c].append((d, k))
    for (p, c), issues in groups.items():
        issues.sort()
        for i, (d, k) in enumerate(issues):
            hit = i + 3 < len(issues) and (issues[i + 3][0] - d).days <= 365
            if not (c == "PNC167" and p in epilepsy and d >= epilepsy[p]):
                flagged.append((p, "Constipation" if c == "CON150" else "Pain", d, c, k, int(hit)))
    out, runs = set(), defaultdict(list)
    for r in sorted(flagged):
        runs[r[0], r[1]].append(r)
    for (p, name), seq in runs.items():
        current = []
        for r in seq + [None]:
            if r is not None and r[5] == 1:
                current.append(r[2])
            elif current:
                out.add((p, name, current[0], current[-1] + timedelta(365), 365, "CPRD"))
                current = []
    return out


def test_prescription_runs_against_the_definition(make):
    rng = random.Random(8)
    rx = sorted({(rng.randint(1, 10), rng.choice(["CON150", "PNC166", "PNC167"]), day(rng.randint(0, 2500)), rng.randint(1, 3))
                 for _ in range(500)})
    first = {p: day(rng.randint(0, 2500)) for p in range(1, 6)}
    df = prescriptions.rx_flag(make("patid long, cond string, issuedate date, prodcodeid long", rx), CFG)
    kept = prescriptions.exclude_after(df, make("patid long, epi_diag_date date", list(first.items())), "PNC167")
    assert {tuple(r) for r in prescriptions.rx_spells(kept, CFG).collect()} == _rx_one_by_one(rx, first)


def test_first_date(make, rows):
    obs = make("patid long, medcodeid long, obsdate date, obstypeid int",
               [(1, 5, "2010-01-01", 1), (1, 5, "2009-01-01", 4), (1, 6, "2008-01-01", 1), (2, 5, "2022-01-01", 1)])
    codes = make("medcodeid long", [(5,)])
    assert rows(prescriptions.first_date(obs, codes, CFG)) == [(1, "2010-01-01")]
