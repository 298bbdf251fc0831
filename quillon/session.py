"""A session with the settings this engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "quillon", **conf: str) -> SparkSession:
    """Get or create: UTC, adaptive execution with skew handling, ANSI left on."""
    builder = SparkSession.builder.appName(app)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"} | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
