"""The Spark session the command line and tests use."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "sparkweft", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; master only where none is configured already."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    fixed = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.session.timeZone": "UTC"}
    for key, value in (fixed | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
