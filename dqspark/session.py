"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "dqspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the UTC zone and adaptive execution; other settings come from the cluster."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return use_utc(builder.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Set the session zone to UTC: wall-clock parsing and epoch arithmetic assume it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
