"""Null-propagating variants of functions that skip nulls in Spark."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_least(*cols: Column) -> Column:
    """Smallest value, null when any value is null."""
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in cols]), F.least(*cols))


def strict_greatest(*cols: Column) -> Column:
    """Largest value, null when any value is null."""
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in cols]), F.greatest(*cols))


def _all_known(c: Column) -> Column:
    return F.count(F.lit(1)) == F.count(c)


def strict_sum(c: Column) -> Column:
    return F.when(_all_known(c), F.sum(c))


def exact_sum(c: Column, kind: str = "decimal(18,12)") -> Column:
    """Sum in fixed point: the same to the last bit however rows are dealt and in whatever order they come. A sum of doubles is not."""
    return F.sum(c.cast(kind))


def strict_avg(c: Column) -> Column:
    return F.when(_all_known(c), F.avg(c))


def strict_max(c: Column) -> Column:
    return F.when(_all_known(c), F.max(c))


def if_known(condition: Column, yes: Column, no: Column) -> Column:
    """``yes`` or ``no``; null when the condition itself is null (a plain ``otherwise`` would take ``no``)."""
    return F.when(condition, yes).when(~condition, no)


def drop_where(condition: Column) -> Column:
    """Filter that removes the rows where the condition is true and keeps those where it is null."""
    return ~F.coalesce(condition, F.lit(False))
