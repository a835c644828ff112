"""Session factory."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that every plan here expects; sizes are left to the cluster.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(app: str = "syntenia", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config(map=DEFAULTS | conf)
    return (builder.master(master) if master else builder).getOrCreate()
