"""The Spark session that the command line and the tests use."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: What the library relies on: timestamps in UTC, and of equal map keys the last one.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with ``CONF``; ``master`` is left to spark-submit unless it is given."""
    builder = SparkSession.builder.appName("lexmill")
    if master:
        builder = builder.master(master)
    for key, value in (CONF | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
