"""Spells: runs of events close enough to count as one episode of illness.

All windows are keyed on (patient, condition) and run over events without repeats, so a window holds at
most a few rows per calendar day. Every order is total; ``source`` ascending puts general practice first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from morbidity.config import ALL_CANCERS, PERMANENT_DAYS, SOURCE_BOTH, Config

KEYS = ("patid", "list_disease_real")
SPELL = ("patid", "list_disease_real", "diag_date", "remission_date", "disease_duration", "source")


def gap_spells(
    events: DataFrame,
    keys: tuple[str, ...] = KEYS,
    date: str = "obsdate",
    gap: str = "disease_duration",
    tiebreak: tuple[str, ...] = ("source", "disease_duration"),
) -> DataFrame:
    """New spell at the first event, and where the time since the previous one exceeds the event's own gap.

    A spell ends its first event's gap after its last event. Only the first events are kept: the last event
    of a spell is the one before the next first event, so the ends need no aggregation and no second sort.
    """
    w = Window.partitionBy(*keys).orderBy(date, *tiebreak)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before, latest = F.lag(date).over(w), F.last(date).over(whole)
    marked = events.withColumns({"before": before, "latest": latest})
    starts = marked.where(F.col("before").isNull() | (F.datediff(date, "before") > F.col(gap)))
    ends = F.coalesce(F.lead("before").over(w), F.col("latest"))
    return starts.select(
        *keys,
        F.col(date).alias("diag_date"),
        F.date_add(ends, F.col(gap)).alias("remission_date"),
        "disease_duration",
        "source",
    )


def event_intervals(events: DataFrame, keys: tuple[str, ...] = KEYS, date: str = "obsdate") -> DataFrame:
    """Each event with the date before it and whether it is the first of its key."""
    w = Window.partitionBy(*keys).orderBy(date, "source", "disease_duration")
    return events.withColumn("before", F.lag(date).over(w)).withColumn(
        "first_epi", F.when(F.row_number().over(w) == 1, 1).otherwise(0)
    )


def first_cancer_spells(events: DataFrame, cfg: Config) -> DataFrame:
    """A patient has each single cancer once, from its first event for ten years."""
    first = F.min(F.struct("obsdate", "source", "disease_duration")).alias("first")
    return (
        events.where(F.col("list_disease_real").isin(*cfg.single_cancers))
        .groupBy(*KEYS)
        .agg(first)
        .select(
            *KEYS,
            F.col("first.obsdate").alias("diag_date"),
            F.date_add("first.obsdate", cfg.cancer_days).alias("remission_date"),
            F.col("first.disease_duration").alias("disease_duration"),
            F.col("first.source").alias("source"),
        )
    )


def all_cancer_spell(cancers: DataFrame, cfg: Config) -> DataFrame:
    """One spell over all cancers: first diagnosis to ten years after the latest first diagnosis.

    Source and duration are those of the alphabetically first cancer.
    """
    named = F.min(F.struct("list_disease_real", "disease_duration", "source")).alias("named")
    return (
        cancers.groupBy("patid")
        .agg(F.min("diag_date").alias("diag_date"), F.max("diag_date").alias("latest"), named)
        .select(
            "patid",
            F.lit(ALL_CANCERS).alias("list_disease_real"),
            "diag_date",
            F.date_add("latest", cfg.cancer_days).alias("remission_date"),
            F.col("named.disease_duration").alias("disease_duration"),
            F.col("named.source").alias("source"),
        )
    )


def resolving_spells(events: DataFrame, cfg: Config) -> DataFrame:
    """Spells of all resolving conditions found in coded records, in one pass over the events.

    A cancer is a spell that never restarts. Its row is then counted under its own name and under all
    cancers, where the rows of a patient fold into one.
    """
    name, cancer = F.col("list_disease_real"), F.col("list_disease_real").isin(*cfg.single_cancers)
    listed = events.where(name.isin(*cfg.resolving_non_cancer, *cfg.single_cancers))
    gap = F.when(cancer, F.lit(PERMANENT_DAYS)).otherwise(F.col("disease_duration"))
    found = gap_spells(listed.withColumn("gap", gap), gap="gap")
    ends = F.when(cancer, F.date_add("diag_date", cfg.cancer_days)).otherwise(F.col("remission_date"))
    # (name to count under, what tells its spells apart)
    own = F.struct(name.alias("name"), F.col("diag_date").alias("spell"))
    shared = F.struct(F.lit(ALL_CANCERS).alias("name"), F.lit(None).cast("date").alias("spell"))
    counted = F.when(cancer, F.array(own, shared)).otherwise(F.array(own))
    first = F.min(F.struct("name", "disease_duration", "source")).alias("first")
    return (
        found.withColumn("remission_date", ends)
        .withColumn("under", F.explode(counted))
        .withColumnsRenamed({"list_disease_real": "name"})
        .withColumns({"list_disease_real": F.col("under.name"), "spell": F.col("under.spell")})
        .repartition(*KEYS)  # also what the merging of close spells needs
        .groupBy(*KEYS, "spell")
        .agg(F.min("diag_date").alias("diag_date"), F.max("remission_date").alias("remission_date"), first)
        .select(*KEYS, "diag_date", "remission_date", "first.disease_duration", "first.source")
    )


def merge_close_spells(spells: DataFrame, days: int = 365) -> DataFrame:
    """Join spells that begin less than ``days`` after the previous one's remission; one row per source."""
    w = Window.partitionBy(*KEYS).orderBy("diag_date", "remission_date", "source")
    apart = F.datediff("diag_date", "before") >= days
    opens = F.when(F.col("before").isNull() | apart, 1).otherwise(0)
    numbered = spells.withColumn("before", F.lag("remission_date").over(w)).withColumn(
        "spell", F.sum(opens).over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    together = Window.partitionBy(*KEYS, "spell")
    return numbered.select(
        *KEYS,
        F.min("diag_date").over(together).alias("diag_date"),
        F.max("remission_date").over(together).alias("remission_date"),
        "source",
    ).distinct()


def merge_sources(spells: DataFrame) -> DataFrame:
    """One row per spell: a single source is kept, two become "both", more become null."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*KEYS, "diag_date"))
    rows = spells.select(*KEYS, "diag_date", "remission_date", "source").distinct().withColumn("n", n)
    source = F.when(F.col("n") == 1, F.col("source")).when(F.col("n") == 2, F.lit(SOURCE_BOTH))
    return rows.withColumn("source", source).drop("n").distinct()
