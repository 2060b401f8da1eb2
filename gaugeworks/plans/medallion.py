"""From landed readings to labelled features and splits.

Every hop is a lazy DataFrame transformation; ``build`` writes the three tables
that later steps read several times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators import contracts, quality
from gaugeworks.operators.features import with_features
from gaugeworks.operators.labeling import COMPRESSOR_FAILURES, FaultWindow, label_by_windows
from gaugeworks.operators.sequence import GAP
from gaugeworks.operators.splits import chronological_split, split_audit, stratified_split
from gaugeworks.roles import SeriesRoles
from gaugeworks.sources import tables

# Where and when a reading landed, the time first.
LANDED = ("_ingested_at", "_source_file", "_source_file_sha256", "_run_id")


def judged(bronze: DataFrame, roles: SeriesRoles, deduplicate: bool = True) -> DataFrame:
    """Readings without exact copies, each with its route and the reasons against it."""
    # The earliest landing of a reading stays; machine and values tell readings apart, files do not.
    source = quality.remove_exact_duplicates(bronze, LANDED) if deduplicate else bronze
    return quality.with_verdict(source, quality.missing_time_rule(roles.time))


def silver(spark: SparkSession, path: str) -> DataFrame:
    """Accepted readings of a judged table; the rejected ones are not read."""
    return spark.read.parquet(path).filter(F.col("route") == quality.ACCEPTED).drop("route", "reject_reasons")


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("route") == quality.REJECTED).drop("route")


def gold(clean: DataFrame, roles: SeriesRoles, windows: Sequence[FaultWindow] = COMPRESSOR_FAILURES) -> DataFrame:
    """Labels, gaps and all features; one shuffle of the readings."""
    labelled = label_by_windows(clean, roles, windows)
    return with_features(labelled, roles, gap=GAP)


def split(features: DataFrame, roles: SeriesRoles, chronological: bool = True, seed: int = 42) -> DataFrame:
    """Chronological by default: a random split puts neighbours in time on both sides."""
    contracts.require_columns(features, [roles.time, roles.label])
    if chronological:
        return chronological_split(features, roles.time)
    return stratified_split(features, roles.label, [*roles.machine, *roles.order], seed)


def build(
    spark: SparkSession,
    bronze: DataFrame,
    root: str,
    roles: SeriesRoles,
    windows: Sequence[FaultWindow] = COMPRESSOR_FAILURES,
    run_id: str = "manual",
    chronological: bool = True,
) -> DataFrame:
    """Write judged readings, quality metrics, features and splits; returns the split audit."""
    index = next((name for name in roles.seq if isinstance(bronze.schema[name].dataType, T.IntegralType)), None)
    tables.overwrite_parquet(judged(bronze, roles), f"{root}/judged", ["route"])
    report = quality.quality_report(bronze, roles.time, index, run_id)
    # A repeated run replaces its own metrics.
    report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(f"{root}/quality")
    tables.overwrite_parquet(gold(silver(spark, f"{root}/judged"), roles, windows), f"{root}/features")
    features = spark.read.parquet(f"{root}/features")
    tables.write_splits(split(features, roles, chronological), f"{root}/splits")
    return split_audit(spark.read.parquet(f"{root}/splits"), roles.label, roles.time)
