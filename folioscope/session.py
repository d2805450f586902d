"""Session settings that every query expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(app: str = "folioscope", **extra: str) -> SparkSession:
    """A session with SETTINGS; on a cluster the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in extra.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
