from datetime import date, timedelta
import random

from pyspark.sql import functions as F

from morbidity.config import AGE_BREAKS, AGE_LABELS, CONDITIONS, STANDARD_WEIGHTS, Config
from morbidity.functions import bands, dates, nulls, text
from morbidity.operators import panel


def test_config_counts():
    cfg = Config()
    assert len(CONDITIONS) == 35 and len(cfg.resolving) == 13 and len(cfg.permanent) == 22
    assert sum(STANDARD_WEIGHTS) == 100_000
    assert len(AGE_LABELS) == len(AGE_BREAKS) == len(STANDARD_WEIGHTS) == 21
    assert AGE_LABELS[-1] == "95-99" and len(cfg.duplicate_practices) == 29


def test_financial_years(make, rows):
    df = make("d date", [("2008-03-31",), ("2008-04-01",), ("2020-01-01",), ("2020-02-29",)])
    y = dates.fyear_of(F.col("d"))
    out = df.select("d", y, dates.year_start(y), dates.year_end(y),
                    dates.days_between(dates.year_start(y), dates.year_end(y)))
    assert rows(out) == [
        ("2008-03-31", 2007, "2007-04-01", "2008-03-31", 366),
        ("2008-04-01", 2008, "2008-04-01", "2009-03-31", 365),
        ("2020-01-01", 2019, "2019-04-01", "2020-03-31", 366),
        ("2020-02-29", 2019, "2019-04-01", "2020-03-31", 366),
    ]


def test_dates_from_text_and_numbers(make, rows):
    df = make("t string, n long", [("05/04/2010", 0), ("2010-04-05", 14704), ("31/02/2010", None)])
    out = df.select(dates.parse_day_first(F.col("t")), dates.from_epoch_days(F.col("n")))
    assert rows(out) == sorted([("2010-04-05", "1970-01-01"), (None, "2010-04-05"), (None, None)], key=repr)


def test_null_propagation(make):
    df = make("a int, b int", [(1, 2), (3, None)])
    a, b = F.col("a"), F.col("b")
    assert [r[0] for r in df.select(nulls.strict_least(a, b)).collect()] == [1, None]
    assert [r[0] for r in df.select(nulls.strict_greatest(a, b)).collect()] == [2, None]
    r = df.agg(nulls.strict_sum(a), nulls.strict_sum(b), nulls.strict_avg(b), nulls.strict_max(b)).first()
    assert tuple(r) == (4, None, None, None)
    assert [r[0] for r in df.select(nulls.if_known(b > 1, F.lit(1), F.lit(0))).collect()] == [1, None]
    assert df.where(nulls.drop_where(b == 2)).count() == 1


def test_disease_names(make):
    df = make("n string", [("Alcohol Misuse",), ("Heart-Failure NOS",), ("Other or not specified",), ("Diagnosis",)])
    plain = [r[0] for r in df.select(text.normalise_disease(F.col("n"))).collect()]
    assert plain == ["alcohol_misuse", "heart_failure_not_otherwise_specified", "not_otherwise_specified",
                     "diagnot_otherwise_specifiedis"]
    assert df.select(text.normalise_disease(F.col("n"), map_side=True)).first()[0] == "alcohol_problems"


def test_outpatient_codes(make):
    df = make("c string", [("I10",), ("I10X",), ("E119-",), ("E11.90",), ("F1X2",)])
    as_written = [r[0] for r in df.select(text.outpatient_icd(F.col("c"))).collect()]
    assert as_written == ["I10.", "I10.0", "E11.9", "E11.90", "F.0.2"]
    fixed = [r[0] for r in df.select(text.outpatient_icd(F.col("c"), fix=True)).collect()]
    assert fixed == ["I10", "I10", "E11.9", "E11.9", "F1X.2"]


def test_bands(make):
    ages = [(2000, 2001), (2000, 2002), (2000, 2000), (2000, 1999), (2000, 1996), (2000, 1995), (2000, 1905), (2000, 1880)]
    df = make("y int, b int", ages).withColumn("age", bands.age_in_year(F.col("y"), F.col("b")))
    out = df.select("age", bands.age_band(bands.age_band_ordinal(F.col("age")))).collect()
    assert [tuple(r) for r in out] == [
        (0, "0-1"), (-2, None), (0, "0-1"), (1, "1-4"), (4, "1-4"), (5, "5-9"), (95, "95-99"), (120, "95-99"),
    ]
    labels = make("d int", [(1,), (2,), (10,), (11,), (None,)]).select(bands.decile_label(F.col("d"))).collect()
    assert [r[0] for r in labels] == ["1 most deprived", "2", "10 least deprived", None, None]


def _share(d, reg, ys, ye, died, censor, death):
    """The definition, one row at a time."""
    if d is None or d > ye or (died is not None and died > censor and death == 1):
        return 0.0
    if d <= censor:
        return ((min(ye, censor) - max(d, ys, reg)).days + 1) / ((ye - ys).days + 1)
    return 0.0


def test_shares_agree_with_the_definition(make):
    """Over random patients and years, leap years and deaths included."""
    rng = random.Random(5)
    made = []
    while len(made) < 600:
        y = rng.randint(2007, 2020)
        ys, ye = date(y, 4, 1), date(y + 1, 3, 31)
        reg = date(2004, 1, 1) + timedelta(rng.randint(0, 6000))
        censor = reg + timedelta(rng.randint(1, 4000))
        died = rng.choice([None, censor, censor + timedelta(rng.randint(1, 900))])
        death = int(died is not None and ys <= died <= ye)
        d = rng.choice([None, date(2003, 1, 1) + timedelta(rng.randint(0, 7000)), ys, ye, censor, reg])
        if reg <= ye and (censor >= ys or death):
            made.append((len(made), d, reg, ys, ye, died, censor, death))
    df = make("id int, d date, regstartdate date, year_start date, year_end date, death_date date, "
              "censor_date date, death int", made)
    bounded = panel.with_bounds(df).withColumn("d", F.coalesce("d", F.expr(panel.NEVER)))
    wide = bounded.selectExpr("id", f"{panel.days_in_bounds('d')} / year_days as s", f"{panel.incident_in_bounds('d')} as i")
    got = {r.id: r for r in wide.collect()}
    for i, d, reg, ys, ye, died, censor, death in made:
        want = _share(d, reg, ys, ye, died, censor, death)
        new = int(d is not None and ys <= d <= ye and reg < ys.replace(year=ys.year - 1))
        assert abs(got[i].s - want) < 1e-12, made[i]
        assert got[i].i == new, made[i]
