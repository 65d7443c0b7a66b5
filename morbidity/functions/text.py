"""Text clean-up of disease names and ICD-10 codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _replaced(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def normalise_disease(c: Column, map_side: bool = False) -> Column:
    """Join key of a disease name. ``map_side`` adds the rewrite that only the disease map gets."""
    out = F.lower(c)
    for old, new in (
        (" ", "_"),
        ("-", "_"),
        ("nos", "not_otherwise_specified"),
        ("other_or_not_specified", "not_otherwise_specified"),
    ):
        out = _replaced(out, old, new)
    return _replaced(out, "alcohol_misuse", "alcohol_problems") if map_side else out


def outpatient_icd(c: Column, fix: bool = False) -> Column:
    """Outpatient code written the way the lookup writes it.

    By default a three-character code keeps its dot and a fifth character is kept, as published.
    ``fix`` gives bare three-character codes and one decimal.
    """
    plain = F.regexp_replace(c, r"[^\p{L}\p{Nd}]", "")
    if fix:
        decimal = F.translate(F.substring(plain, 4, 1), "X", "0")
        bare = (F.length(plain) <= 3) | (F.substring(plain, 4, 10) == "X")
        return F.when(bare, F.substring(plain, 1, 3)).otherwise(
            F.concat(F.substring(plain, 1, 3), F.lit("."), decimal)
        )
    dotted = F.concat(F.substring(plain, 1, 3), F.lit("."), F.substring(plain, 4, 2))
    return F.regexp_replace(dotted, r".X", ".0")
