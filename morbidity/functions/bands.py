"""Age bands and deprivation labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from morbidity.config import AGE_BREAKS, AGE_LABELS, DECILE_LABELS


def age_in_year(fyear: Column, yob: Column) -> Column:
    age = fyear - yob
    return F.when(age == -1, F.lit(0)).otherwise(age)


def age_band_ordinal(age: Column) -> Column:
    """1-based position of the left-closed band; the last band is open-ended, negative ages have none."""
    chain = None
    for i in range(len(AGE_BREAKS) - 1, -1, -1):
        test, value = age >= AGE_BREAKS[i], F.lit(i + 1)
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return chain


def age_band(ordinal: Column) -> Column:
    labels = F.array(*[F.lit(x) for x in AGE_LABELS])
    return F.when(ordinal.isNotNull(), F.element_at(labels, ordinal))


def decile_label(decile: Column) -> Column:
    labels = F.array(*[F.lit(x) for x in DECILE_LABELS])
    return F.when(decile.between(1, len(DECILE_LABELS)), F.element_at(labels, decile.cast("int")))
