"""The patient-by-year panel.

Everything is joined per patient before years or conditions multiply the rows, and the panel stays
partitioned by patient from the first join to the last column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from morbidity.config import Config, column_name
from morbidity.functions import dates
from morbidity.functions.nulls import strict_greatest, strict_least
from morbidity.operators.spells import KEYS


def panel_skeleton(patients: DataFrame, cfg: Config) -> DataFrame:
    """One row per patient and study year of follow-up, plus the year of a death after censoring.

    The years are generated per patient, so no row is made to be dropped again.
    """
    first = F.greatest(dates.fyear_of(F.col("regstartdate")), F.lit(cfg.first_year))
    last = F.least(dates.fyear_of(F.coalesce("censor_date", F.lit(cfg.end))), F.lit(cfg.last_year))
    years = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    if cfg.keep_death:
        died = dates.fyear_of(F.col("death_date"))
        death_year = F.when(died.between(first, F.lit(cfg.last_year)), F.array(died))
        years = F.array_union(years, F.coalesce(death_year, F.array().cast("array<int>")))
    fyear = F.col("fyear")
    long = patients.where("regstartdate is not null").withColumn("fyear", F.explode(years))
    dated = long.withColumns({"year_start": dates.year_start(fyear), "year_end": dates.year_end(fyear)})
    dies = F.col("death_date").between(F.col("year_start"), F.col("year_end"))
    return dated.withColumn("death", F.when(dies, 1).otherwise(0))


def with_weight(panel: DataFrame) -> DataFrame:
    """Share of the year's days under follow-up: none in the year of a death after follow-up had ended."""
    lived_from = strict_greatest(F.col("regstartdate"), F.col("year_start"))
    lived_to = strict_least(F.col("censor_date"), F.col("year_end"))
    lived = dates.days_between(lived_from, lived_to)
    of_year = dates.days_between(F.col("year_start"), F.col("year_end"))
    return panel.withColumn("weight", F.when(lived > 0, lived / of_year).when(lived <= 0, F.lit(0.0)))


def _earliest(date: str, condition: str, name: str) -> Column:
    return F.min(F.when(F.col("list_disease_real") == F.lit(condition), F.col(date))).alias(name)


def permanent_wide(permanent: DataFrame, cfg: Config) -> DataFrame:
    """Earliest date per patient, one column per permanent condition."""
    columns = [_earliest("diag_date", c, column_name(c)) for c in cfg.permanent]
    listed = permanent.where(F.col("list_disease_real").isin(*cfg.permanent))
    return listed.groupBy("patid").agg(*columns)


def rolled_spells(spells: DataFrame, cfg: Config) -> DataFrame:
    """The diagnosis and remission in force per patient, condition and study year.

    A year's earliest diagnosis, with its own remission, holds until the next year that has one. A patient
    has at most one row per condition and calendar year here, whatever the number of events behind it.
    """
    fyear = dates.fyear_of(F.col("diag_date"))
    kept = spells.where(F.col("remission_date") >= F.lit(cfg.start)).select(
        *KEYS, fyear.alias("since"), "diag_date", "remission_date"
    )
    earliest = F.min(F.struct("diag_date", "remission_date")).alias("d")
    # a patient's spells are few by now: one exchange by patient serves every step from here to the panel
    yearly = kept.repartition("patid").groupBy(*KEYS, "since").agg(earliest)
    following = F.lead("since").over(Window.partitionBy(*KEYS).orderBy("since"))
    first = F.greatest("since", F.lit(cfg.first_year))
    last = F.least(F.coalesce(F.col("following") - 1, F.lit(cfg.last_year)), F.lit(cfg.last_year))
    return (
        yearly.withColumn("following", following)
        .where(first <= last)
        .select(*KEYS, F.explode(F.sequence(first, last)).alias("fyear"), "d.diag_date", "d.remission_date")
    )


def resolving_wide(spells: DataFrame, cfg: Config) -> DataFrame:
    """Diagnosis and remission in force per patient: a map from study year to two dates per condition.

    The map has an entry per study year at most. It lets the panel take a year's dates from the patient's own
    row, so no panel row is ever shuffled to meet them.
    """
    columns = []
    for c in cfg.resolving:
        columns.append(_earliest("diag_date", c, column_name(c)))
        columns.append(_earliest("remission_date", c, f"rem_{column_name(c)}"))
    listed = spells.where(F.col("list_disease_real").isin(*cfg.resolving))
    yearly = rolled_spells(listed, cfg).groupBy("patid", "fyear").agg(*columns)
    entry = F.struct("fyear", F.struct(*[c for c in yearly.columns if c not in ("patid", "fyear")]))
    return yearly.groupBy("patid").agg(F.map_from_entries(F.collect_list(entry)).alias("in_force"))


# Per-row bounds that all shares of a panel row have in common. None is null: a bound or diagnosis that does
# not exist is a date no year reaches, which spares the wide projections a null check per operation.
BOUNDS = ("lived_from", "lived_to", "lived_days", "new_from", "year_days")
NEVER = "date'9999-12-31'"
BEFORE_ALL = "date'0001-01-01'"


def with_bounds(panel: DataFrame) -> DataFrame:
    """Adds the first and last day lived in the year, and the day from which a diagnosis counts as new."""
    lost = "coalesce(death_date > censor_date and death = 1, false)"
    dated = panel.selectExpr(
        "*",
        f"coalesce(greatest(year_start, regstartdate), {NEVER}) as lived_from",
        f"coalesce(if({lost}, null, least(year_end, censor_date)), {BEFORE_ALL}) as lived_to",
        f"coalesce(if(regstartdate < add_months(year_start, -12), year_start, null), {NEVER}) as new_from",
        "cast(coalesce(datediff(year_end, year_start) + 1, 365) as double) as year_days",
    )
    return dated.selectExpr("*", "datediff(lived_to, lived_from) + 1 as lived_days")


def days_in_bounds(date: str) -> str:
    """Days of the year from the date on that were lived."""
    return f"if({date} > lived_to, 0, if({date} <= lived_from, lived_days, datediff(lived_to, {date}) + 1))"


def incident_in_bounds(date: str) -> str:
    return f"if({date} >= new_from and {date} <= year_end, 1, 0)"


def _permanent_columns(cfg: Config) -> list[str]:
    names = [column_name(c) for c in cfg.permanent]
    shares = [f"{days_in_bounds(c)} / year_days as prop_{c}" for c in names]
    return shares + [f"{incident_in_bounds(c)} as inc_{c}" for c in names]


def _resolving_columns(cfg: Config) -> list[str]:
    """Diagnosed less in remission; new cases."""
    names = [column_name(c) for c in cfg.resolving]
    shares = [f"({days_in_bounds(c)} - {days_in_bounds(f'rem_{c}')}) / year_days as prop_{c}" for c in names]
    return shares + [f"{incident_in_bounds(c)} as inc_{c}" for c in names]


def _years(dated: DataFrame, cfg: Config) -> DataFrame:
    """Panel rows with bounds, of patients that already carry their diagnoses."""
    return with_bounds(with_weight(panel_skeleton(dated, cfg)))


def _with_permanent(patients: DataFrame, permanent: DataFrame, cfg: Config) -> DataFrame:
    return patients.join(permanent_wide(permanent, cfg), "patid", "left")


def _with_resolving(patients: DataFrame, spells: DataFrame, cfg: Config) -> DataFrame:
    return patients.join(resolving_wide(spells, cfg), "patid", "left")


def _dates_of_year(rows: DataFrame, permanent: bool, resolving: bool, cfg: Config) -> DataFrame:
    """Replaces the diagnoses a patient carries by the dates that count in the row's year, none of them null."""
    own = {column_name(c): column_name(c) for c in cfg.permanent} if permanent else {}
    kept = [c for c in rows.columns if c not in own and c != "in_force"]
    if resolving:
        rows = rows.selectExpr(*kept, *own, "try_element_at(in_force, fyear) as now")
        for c in cfg.resolving:
            for name in (column_name(c), f"rem_{column_name(c)}"):
                own[name] = f"now.{name}"
    return rows.selectExpr(*kept, *[f"coalesce({date}, {NEVER}) as {name}" for name, date in own.items()])


def permanent_panel(patients: DataFrame, permanent: DataFrame, cfg: Config) -> DataFrame:
    """Panel rows with prop_ and inc_ columns of the permanent conditions."""
    rows = _years(_with_permanent(patients, permanent, cfg), cfg)
    kept = [*patients.columns, "fyear", "year_start", "year_end", "death", "weight"]
    return _dates_of_year(rows, True, False, cfg).selectExpr(*kept, *_permanent_columns(cfg))


def resolving_panel(patients: DataFrame, spells: DataFrame, cfg: Config) -> DataFrame:
    """Panel rows with prop_ and inc_ columns of the resolving conditions."""
    rows = _years(_with_resolving(patients, spells, cfg), cfg)
    kept = [*patients.columns, "fyear", "year_start", "year_end", "death", "weight"]
    return _dates_of_year(rows, False, True, cfg).selectExpr(*kept, *_resolving_columns(cfg))


FIRST_COLUMNS = (
    "patid", "gender", "yob", "ethnicity", "imd2015_decile", "region", "fyear", "pracid", "regstartdate",
    "censor_date", "death_date", "year_start", "year_end", "death", "weight",
)


def assemble_panel(patients: DataFrame, permanent: DataFrame, spells: DataFrame, cfg: Config) -> DataFrame:
    """The full panel: one row per patient and year, with every condition of the configuration.

    ``patients`` is the patient table, one row per patient.
    """
    carried = patients.select(*[c for c in FIRST_COLUMNS if c in patients.columns])
    dated = _with_resolving(_with_permanent(carried, permanent, cfg), spells, cfg)
    rows = _dates_of_year(_years(dated, cfg), True, True, cfg)
    first = [c for c in FIRST_COLUMNS if c in rows.columns]
    full = rows.selectExpr(*first, *_permanent_columns(cfg), *_resolving_columns(cfg))
    names = cfg.condition_columns
    return full.select(*first, *[f"prop_{c}" for c in names], *[f"inc_{c}" for c in names])
