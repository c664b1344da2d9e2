"""Session defaults for standalone use and tests."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(app: str = "mentionmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC; callers' settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # a checkpoint goes with the last plan that reads it
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
