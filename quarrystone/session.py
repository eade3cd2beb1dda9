"""The Spark session this library expects: AQE on, UTC, few partitions on small machines."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "quarrystone", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings below; ``conf`` (dots as double underscores) overrides them."""
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # whole texts may be long: batches of few rows for Python
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (base | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
