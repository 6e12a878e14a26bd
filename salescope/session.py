"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: small shuffle partitions merge, skewed ones split,
    # and a split may add an exchange when that is what it takes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Do not record the Python call site of every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "salescope", master: str | None = None, **extra: str) -> SparkSession:
    """A session with these settings; cluster sizing stays with the caller."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
