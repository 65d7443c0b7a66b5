"""Multimorbidity score of a panel row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from morbidity.config import SCORE_COMPONENTS, Config


def with_score(panel: DataFrame, cfg: Config) -> DataFrame:
    """Weighted sum of the shares, null when one is null; component conditions are dropped."""
    terms = " + ".join(f"prop_{c} * {w}D" for c, w in cfg.score_weights.items())
    kept = panel.drop(*[f"prop_{c}" for c in SCORE_COMPONENTS])
    return kept.withColumn("cam_score_general", F.expr(terms))
