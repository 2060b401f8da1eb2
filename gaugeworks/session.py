"""Session settings the operators are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Wide profiles (dozens of sensors times several statistics) stay inside
    # whole-stage codegen with this limit.
    "spark.sql.codegen.maxFields": "400",
}


def build_session(app_name: str = "gaugeworks", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or return) a session with the library's settings applied.

    ``extra`` uses underscores for dots, e.g. ``spark_driver_memory="8g"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = dict(SETTINGS)
    settings.update({name.replace("_", "."): value for name, value in extra.items()})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
