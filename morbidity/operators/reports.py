"""Crude and directly standardised reports of a cell table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ("fyear", "agecat", "agecat_ord", "gender", "imd_deciles", "imd2015_decile")


def weighted_mean(value: str, weight: str, strict: bool = False) -> Column:
    """Mean of the known values; ``strict`` gives null when one of them has no weight. Sums are in fixed point: cells may come in any order."""
    used = f"if({value} is null, null, {weight})"
    total, weights = (f"cast(sum(cast({x} as decimal(38,20))) as double)" for x in (f"{value} * {weight}", used))
    mean = f"{total} / nullif({weights}, 0)"
    return F.expr(f"if(count({value}) = count({used}), {mean}, null)" if strict else mean)


def _keys(grouping: tuple[str, ...]) -> list[str]:
    keys = ["fyear", *grouping]
    return keys + ["agecat_ord"] if "agecat" in grouping else keys


def weighted_report(
    cells: DataFrame, values: list[str], weight: str, reports: dict[str, tuple[str, ...]], strict: bool = False
) -> DataFrame:
    """All reports of a family in one pass over the cells, as one long table led by the report name.

    Each report is a grouping set; a key it does not group by is null. Rows without a weight do not count.
    """
    used = cells if strict else cells.where(F.col(weight).isNotNull())
    sets = {name: _keys(grouping) for name, grouping in reports.items()}
    means = [weighted_mean(v, weight, strict).alias(v) for v in values]
    grouped = used.groupingSets([list(s) for s in sets.values()], *KEYS).agg(
        F.grouping_id(*KEYS).alias("grouping"), *means
    )
    label = None
    for name, keys in sets.items():
        # grouping_id has a bit for every key the row is not grouped by, the first key in the highest bit
        bits = sum(1 << (len(KEYS) - 1 - i) for i, k in enumerate(KEYS) if k not in keys)
        test = F.col("grouping") == bits
        label = F.when(test, F.lit(name)) if label is None else label.when(test, F.lit(name))
    return grouped.select(label.alias("report"), *KEYS, *values)


def in_order(report: DataFrame) -> DataFrame:
    """Presentation order. Reports are a few thousand rows at most."""
    return report.orderBy("report", "fyear", "agecat_ord", "gender", "imd2015_decile")
