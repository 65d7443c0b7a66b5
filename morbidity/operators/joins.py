"""Joins to code tables and to the cohort.

They are plain equi-joins. Spark broadcasts a side by its estimated bytes, and its adaptive skew join deals out the rows of a
hot key by the map tasks they came from, equal rows included; ``session.tuned`` switches that on. Nothing is asked of
the data while a plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(events: DataFrame, table: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join events to a code table. A missing key never matches."""
    return events.join(table, key, how)


def restrict_to(events: DataFrame, patients: DataFrame) -> DataFrame:
    """Rows of listed patients only."""
    return events.join(patients.select("patid"), "patid", "left_semi")
