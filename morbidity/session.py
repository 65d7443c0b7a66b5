"""Session settings the joins and aggregations rely on. ``tuned`` sets them on the caller's running session, for all its plans."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where the split costs one more shuffle of its result
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # the panel's projections are wide: beyond 8,000 bytes the JVM leaves a method to its interpreter, while
    # Spark's operator-by-operator code for the same plan comes in methods small enough to compile
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def tuned(spark: SparkSession) -> SparkSession:
    """The same session with the settings applied. The number of shuffle partitions stays the cluster's."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
