"""Train the models on the splits, compare them, and name the one to deploy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.columns import ref
from gaugeworks.operators import contracts, evaluation, training
from gaugeworks.operators.splits import SPLITS
from gaugeworks.roles import SeriesRoles
from gaugeworks.sources import models, tables


def train_all(train: DataFrame, features: Sequence[str], label: str) -> list[training.FaultModel]:
    return [
        training.train_logistic(train, features, label),
        training.train_forest(train, features, label),
        training.train_network(train, features, label),
    ]


def long_scores(fitted: Sequence[training.FaultModel], data: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """``(model, keys, label, probability)`` of several models on one data set."""
    parts = [
        model.score(data).select(
            F.lit(model.name).alias("model"),
            *[ref(key) for key in keys],
            ref(label).alias("label"),
            F.col(training.PROBABILITY).alias("probability"),
        )
        for model in fitted
    ]
    scores = parts[0]
    for part in parts[1:]:
        scores = scores.unionByName(part)
    return scores


def deployment(spark: SparkSession, fitted: Sequence[training.FaultModel], gate: DataFrame) -> DataFrame:
    """One row: the model to deploy, null if all are fallbacks, beside the verdict on the search."""
    states = spark.createDataFrame(
        [(model.name, model.status, model.name == training.TUNED_FOREST) for model in fitted],
        "model string, status string, is_tuned boolean",
    )
    chosen = training.select_deployable(states).agg(F.first("model").alias("model")).first()["model"]
    return gate.withColumnsRenamed({"status": "search_status", "reason": "search_reason"}).withColumn("model", F.lit(chosen).cast("string"))


def run(
    spark: SparkSession,
    splits_path: str,
    root: str,
    roles: SeriesRoles,
    candidates: Sequence[Mapping[str, object]] | None = None,
) -> DataFrame:
    """Check the splits, train, save, and return the comparison on the validation rows.

    With ``candidates`` a forest search runs too, if both data sets have both
    classes.  Under ``root``: ``models/<name>``, ``scores`` of the validation
    rows (written once, read by every report), ``evaluation``, ``thresholds``,
    and ``deployment``, whose model is also saved as ``models/deployed``.
    """
    splits = spark.read.parquet(splits_path)
    absent = [row["split"] for row in contracts.missing_splits(splits).filter(~F.col("present")).collect()]
    if absent:
        raise contracts.ContractError(f"splits without rows: {absent}, required {SPLITS}")
    train = contracts.clean_labels(tables.read_split(spark, splits_path, "train"), roles.label)
    validation = contracts.clean_labels(tables.read_split(spark, splits_path, "validation"), roles.label)
    features = contracts.feature_columns(train, validation, excluded=[*roles.machine, *roles.seq])
    fitted = train_all(train, features, roles.label)
    gate = training.class_gate(train, validation, roles.label)
    if candidates and gate.first()["status"] == training.READY:
        fitted.append(training.search_forest(train, validation, features, roles.label, candidates).best)
    for model in fitted:
        models.save_model(spark, model, f"{root}/models/{model.name}")
    scores = long_scores(fitted, validation, roles.label, [*roles.machine, *roles.order])
    tables.overwrite_parquet(scores, f"{root}/scores")
    scores = spark.read.parquet(f"{root}/scores")
    tables.overwrite_parquet(evaluation.compare_models(scores), f"{root}/evaluation")
    tables.overwrite_parquet(evaluation.threshold_table(scores, models=["model"]), f"{root}/thresholds")
    tables.overwrite_parquet(deployment(spark, fitted, gate), f"{root}/deployment")
    chosen = spark.read.parquet(f"{root}/deployment").first()["model"]
    for model in fitted:
        if model.name == chosen:
            models.save_model(spark, model, f"{root}/models/deployed")
    return spark.read.parquet(f"{root}/evaluation")
