"""Dates and financial years (1 April to 31 March, named by the year they begin in)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fyear_of(d: Column) -> Column:
    return F.year(F.add_months(d, -3))


def year_start(fyear: Column) -> Column:
    return F.make_date(fyear, F.lit(4), F.lit(1))


def year_end(fyear: Column) -> Column:
    return F.date_sub(F.make_date(fyear + 1, F.lit(4), F.lit(1)), 1)


def days_between(first: Column, last: Column) -> Column:
    """Number of days from first to last, both counted."""
    return F.datediff(last, first) + 1


def parse_day_first(c: Column) -> Column:
    """Day-month-year text to a date, null when it does not parse."""
    return F.to_date(F.try_to_timestamp(c, F.lit("dd/MM/yyyy")))


def from_epoch_days(c: Column) -> Column:
    return F.date_from_unix_date(c.cast("int"))
