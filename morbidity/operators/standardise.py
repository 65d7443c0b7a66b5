"""Age bands, the standard population, the set reported on, and its cells."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from morbidity.config import AGE_LABELS, DECILE_LABELS, STANDARD_WEIGHTS, UNREPORTED, Config
from morbidity.functions.bands import age_band, age_band_ordinal, age_in_year, decile_label
from morbidity.functions.nulls import exact_sum

STRATA = ("agecat", "gender", "imd_deciles")
CELL = ("fyear", "imd_deciles", "imd2015_decile", "agecat", "agecat_ord", "gender", "wt_esp")


def with_bands(panel: DataFrame) -> DataFrame:
    aged = panel.withColumn("age", age_in_year(F.col("fyear"), F.col("yob")))
    placed = aged.withColumn("agecat_ord", age_band_ordinal(F.col("age")))
    return placed.withColumns(
        {"agecat": age_band(F.col("agecat_ord")), "imd_deciles": decile_label(F.col("imd2015_decile"))}
    )


def standard_population(spark: SparkSession, cfg: Config) -> DataFrame:
    """Weight of every age band, sex, decile and year: as many rows as the configuration multiplies to."""
    pairs = zip(AGE_LABELS, STANDARD_WEIGHTS)
    bands = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(float(w)).alias("w")) for a, w in pairs])
    genders = F.array(*[F.lit(g) for g in cfg.genders])
    deciles = F.array(*[F.lit(d) for d in DECILE_LABELS])
    years = F.sequence(F.lit(cfg.standard_first_year), F.lit(cfg.standard_last_year))
    return (
        spark.range(1)
        .select(F.explode(bands).alias("band"))
        .select(F.col("band.a").alias("agecat"), F.explode(genders).alias("gender"), F.col("band.w").alias("wt_esp"))
        .select("agecat", "gender", F.explode(deciles).alias("imd_deciles"), "wt_esp")
        .select("agecat", "gender", "imd_deciles", F.explode(years).alias("fyear"), "wt_esp")
    )


def active_rows(panel: DataFrame, standard: DataFrame, cfg: Config) -> DataFrame:
    """Scored panel rows that the reports count, with bands, standard weight and score flags.

    The standard population is broadcast: its size is fixed by the configuration, not by the data.
    """
    years = F.col("fyear").between(cfg.report_first_year, cfg.report_last_year)
    ages = F.col("age").between(cfg.age_from, cfg.age_to)
    kept = with_bands(panel.where(years & (F.col("weight") != 0))).where(ages)
    score = F.col("cam_score_general")
    return (
        kept.join(F.broadcast(standard), [*STRATA, "fyear"], "left")
        .drop(*[f"prop_{c}" for c in UNREPORTED])
        .withColumns(
            {
                "dum_cam_score_greater_0": (score > 0).cast("int"),
                "dum_cam_score_greater_1_5": (score > 1.5).cast("int"),
            }
        )
    )


def active_set(active: DataFrame) -> DataFrame:
    """Adds the number of patients per year and per year and stratum.

    The panel has one row per patient and year, so rows are counted, once for all strata; a year's number is the sum of its strata's.
    """
    per_cell = active.groupBy("fyear", *STRATA).agg(F.count(F.lit(1)).alias("popsize"))
    renamed = {c: f"cell_{c}" for c in ("fyear", *STRATA)}
    total = F.sum("popsize").over(Window.partitionBy("fyear"))
    cell = per_cell.withColumn("popsize_tot", total).withColumnsRenamed(renamed)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(name)) for c, name in renamed.items()])
    return active.join(cell, same).drop(*renamed.values())


def _sized(cells: DataFrame, strict: bool) -> DataFrame:
    """Population sizes and both weights of a cell table. These windows see cells, never patients.

    With ``strict``, one cell without a standard weight leaves its whole year without them.
    """
    year = Window.partitionBy("fyear")
    total = F.sum("wt_esp").over(year)
    if strict:
        total = F.when(F.count(F.lit(1)).over(year) == F.count("wt_esp").over(year), total)
    return cells.withColumns(
        {
            "popsize": F.sum("n").over(Window.partitionBy("fyear", *STRATA)),
            "popsize_tot": F.sum("n").over(year),
            "tot_wt_esp": total,
        }
    ).withColumns(
        {
            "actual_pop_wt": F.col("popsize") / F.col("popsize_tot"),
            "standard_pop_wt": F.col("wt_esp") / F.col("tot_wt_esp"),
        }
    ).drop("n")


def cell_states(active: DataFrame, cfg: Config) -> DataFrame:
    """Per cell: rows, rows with a score and their sum, patients under follow-up, and for each condition rows with a share and patients with it.

    Sums of states are states (``merged``), so reports of several extracts or buckets need their states alone. A panel has one row per patient and
    year, so counting rows counts patients: one aggregation for both report families, combined map-side, and no patient identifier is
    shuffled. The score is summed in fixed point.
    """
    score = F.col("cam_score_general")
    states = [
        F.count(F.lit(1)).alias("n"),
        F.count(score).alias("n_score"),
        exact_sum(score).cast("decimal(38,12)").alias("sum_score"),
        F.count_if(F.col("weight") > 0).alias("n_under"),
    ]
    for c in cfg.reported_columns:
        share = F.col(f"prop_{c}")
        states += [F.count(share).alias(f"n_{c}"), F.count_if(share > 0).alias(f"ill_{c}")]
    return active.groupBy(*CELL).agg(*states)


def merged(states: list[DataFrame]) -> DataFrame:
    """One table of states for panels without a patient in common."""
    whole = reduce(DataFrame.unionByName, states)
    sums = [F.sum(c).cast(whole.schema[c].dataType).alias(c) for c in whole.columns if c not in CELL]
    return whole.groupBy(*CELL).agg(*sums)


def cells_of(states: DataFrame, cfg: Config) -> DataFrame:
    """Mean score, and for each condition the patients with it over patients under follow-up, per cell. A null score or share leaves a
    cell's value null."""
    under = F.when(F.col("n_under") != 0, F.col("n_under"))
    mean = F.when(F.col("n_score") == F.col("n"), F.col("sum_score").cast("double") / F.col("n")).alias("cam_score_general")
    shares = [(F.when(F.col(f"n_{c}") == F.col("n"), F.col(f"ill_{c}")) / under).alias(f"prev_{c}") for c in cfg.reported_columns]
    return _sized(states.select(*CELL, "n", mean, *shares), cfg.strict)


def report_cells(active: DataFrame, cfg: Config) -> DataFrame:
    return cells_of(cell_states(active, cfg), cfg)
