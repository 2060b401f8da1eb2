"""Saved models: the fitted stage, its features and preparation, and metric rows."""

from __future__ import annotations

import json

from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession

from gaugeworks.operators.contracts import check_model
from gaugeworks.operators.training import FaultModel, ForestParts, Preparation

METRICS_SCHEMA = "model string, metric string, value double"


def save_model(spark: SparkSession, fitted: FaultModel, path: str) -> None:
    """Write the model under ``path/stage`` and its description under ``path/description``.

    Of a forest in parts each is a stage of its own, ``path/stage/<number>``.
    """
    trees = []
    if isinstance(fitted.model, ForestParts):
        trees = list(fitted.model.trees)
        for number, part in enumerate(fitted.model.paths):
            RandomForestClassificationModel.load(part).write().overwrite().save(f"{path}/stage/{number}")
    elif fitted.model is not None:
        fitted.model.write().overwrite().save(f"{path}/stage")
    description = {
        "name": fitted.name,
        "features": list(fitted.features),
        "medians": dict(fitted.preparation.medians),
        "means": dict(fitted.preparation.means),
        "spreads": dict(fitted.preparation.spreads),
        "constant": fitted.constant,
        "parameters": dict(fitted.parameters),
        "trees_of_parts": trees,
    }
    document = spark.createDataFrame([(json.dumps(description),)], "value string")
    document.coalesce(1).write.mode("overwrite").text(f"{path}/description")


def load_model(spark: SparkSession, path: str) -> FaultModel:
    description = json.loads(spark.read.text(f"{path}/description", wholetext=True).first()[0])
    preparation = Preparation(
        tuple(description["features"]), description["medians"], description["means"], description["spreads"]
    )
    model = None
    trees = description.get("trees_of_parts")
    if trees:
        model = ForestParts(tuple(f"{path}/stage/{number}" for number in range(len(trees))), tuple(trees), len(description["features"]))
    elif description["constant"] is None:
        model = DefaultParamsReader.loadParamsInstance(f"{path}/stage", spark)
        check_model(len(description["features"]), description["features"], model.numFeatures)
    return FaultModel(
        description["name"], preparation, model, description["constant"], description["parameters"]
    )


def append_metrics(spark: SparkSession, path: str, model: str, metrics: dict[str, float]) -> DataFrame:
    """Append metric rows of a model run; returns what was written."""
    rows = spark.createDataFrame(
        [(model, name, None if value is None else float(value)) for name, value in metrics.items()],
        METRICS_SCHEMA,
    )
    rows.coalesce(1).write.mode("append").parquet(path)
    return rows
