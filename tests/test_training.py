from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Observation
from pyspark.sql import functions as F

from gaugeworks.operators import splits, training
from gaugeworks.operators.contracts import ContractError
from gaugeworks.operators.features import with_features
from gaugeworks.operators.labeling import FaultWindow
from gaugeworks.plans import medallion, training_flow
from gaugeworks.roles import COMPRESSOR_ANALOG, COMPRESSOR_FLAGS, SeriesRoles
from gaugeworks.sources import models
from gaugeworks.streaming.scoring import score_stream


@pytest.fixture(scope="module")
def data(spark):
    base = spark.range(600).select(
        F.col("id"),
        (F.col("id") % 4 == 0).cast("int").alias("fault_label"),
    )
    noise = F.sin(F.col("id") * 12.9898) * 2
    return base.withColumns(
        {
            "a": F.col("fault_label") * 1.5 + noise,
            "b": F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.cos(F.col("id") * 3.7) + F.col("fault_label")),
            "c": F.lit(4.0),
        }
    ).cache()


def test_preparation(spark):
    df = spark.createDataFrame(
        [(1.0, None, 2.0), (2.0, None, 2.0), (float("inf"), None, 2.0), (10.0, None, None)], "a double, b double, c double"
    )
    fitted = training.fit_preparation(df, ["a", "b", "c"], scale=True)
    assert fitted.medians == {"a": 2.0, "b": 0.0, "c": 2.0}
    assert fitted.spreads["b"] == 1.0 and fitted.spreads["c"] == 1.0
    values = np.array([1.0, 2.0, 2.0, 10.0])
    assert fitted.spreads["a"] == pytest.approx(values.std())
    scaled = [row["a"] for row in fitted.prepared(df).collect()]
    assert np.allclose(scaled, (values - values.mean()) / values.std())


def test_balanced_weights():
    assert training.balanced_weights({0: 225, 1: 10}) == {0: 235 / 450, 1: 235 / 20}
    assert training.balanced_weights({0: 5, 1: 0}) == {0: 1.0}


def test_logistic_regression_is_the_penalized_optimum(data):
    fitted = training.train_logistic(data, ["a", "b", "c"])
    rows = fitted.preparation.prepared(data).select("a", "b", "c", "fault_label").toPandas()
    x, y = rows[["a", "b", "c"]].to_numpy(), rows["fault_label"].to_numpy()
    weights = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    coefficients, intercept = np.array(fitted.model.coefficients), fitted.model.intercept
    p = 1 / (1 + np.exp(-(x @ coefficients + intercept)))
    # Stationarity of |w|^2 / 2 + sum(weight * log loss).
    assert np.allclose(x.T @ (weights * (p - y)) + coefficients, 0, atol=2e-2)
    assert abs(np.sum(weights * (p - y))) < 2e-2


@pytest.mark.parametrize(
    "train", [training.train_logistic, lambda d, f: training.train_forest(d, f, trees=5, depth=4), training.train_network]
)
def test_models_beat_chance_and_keep_the_input(data, train):
    fitted = train(data, ["a", "b"])
    scored = fitted.score(data)
    assert scored.columns == [*data.columns, training.PROBABILITY, training.PREDICTION]
    assert scored.select("id", "a", "b").exceptAll(data.select("id", "a", "b")).isEmpty()
    area = training.ranking_scores(scored, "fault_label", training.PROBABILITY).first()["roc_auc"]
    assert area > 0.7
    assert fitted.status == training.COMPLETED


@pytest.mark.parametrize("only", [0, 1])
def test_single_class_falls_back_to_a_constant(data, only):
    one = data.filter(F.col("fault_label") == only)
    for train in (training.train_logistic, training.train_forest, training.train_network):
        fitted = train(one, ["a"])
        row = fitted.score(data).agg(F.min(training.PROBABILITY), F.max(training.PROBABILITY), F.max(training.PREDICTION)).first()
        assert tuple(row) == (float(only), float(only), only)
        assert fitted.status == training.COMPLETED_WITH_WARNING
    with pytest.raises(ContractError):
        training.train_logistic(data.limit(0), ["a"])


def test_search_prefers_the_first_of_equals(data):
    same = {"trees": 3, "depth": 3, "leaf": 1}
    result = training.search_forest(data, data, ["a", "b"], candidates=[same, dict(same)])
    assert len(result.trials) == 2 and result.trials[0] == result.trials[1]
    assert result.best.parameters["n_estimators"] == 3
    with pytest.raises(ContractError):
        training.search_forest(data.filter("fault_label = 0"), data, ["a"])


def test_models_score_after_an_observed_write(spark, data, tmp_path):
    seen = Observation()
    data.observe(seen, F.count("*").alias("n")).write.parquet(str(tmp_path / "observed"))
    assert seen.get["n"] == 600
    for fitted in (training.train_logistic(data, ["a", "b"]), training.train_forest(data, ["a", "b"], trees=3, depth=3)):
        scored = fitted.score(data)
        assert scored.filter(F.col(training.PROBABILITY).between(0, 1)).count() == 600


def test_forest_in_parts(spark, data, tmp_path, monkeypatch):
    whole = training.train_forest(data, ["a", "b"], trees=12, depth=6)
    monkeypatch.setattr(training._fit_forest, "__defaults__", (150,))
    fitted = training.train_forest(data, ["a", "b"], trees=12, depth=6)
    assert isinstance(fitted.model, training.ForestParts)
    assert sum(fitted.model.trees) == 12 and len(fitted.model.trees) > 2
    loaded = [RandomForestClassificationModel.load(path) for path in fitted.model.paths]
    assert [part.getNumTrees for part in loaded] == list(fitted.model.trees)
    scored = fitted.score(data)
    assert scored.columns == [*data.columns, training.PROBABILITY, training.PREDICTION]
    # The mean over all trees, whatever the sizes of the parts.
    vectors = training.assemble(fitted.preparation.prepared(data), ["a", "b"]).select("id", training.VECTOR).collect()
    expected = {row["id"]: sum(n * part.predictProbability(row[training.VECTOR])[1] for n, part in zip(fitted.model.trees, loaded)) / 12 for row in vectors}
    found = {row["id"]: row[training.PROBABILITY] for row in scored.collect()}
    assert found == pytest.approx(expected)
    areas = [training.ranking_scores(m.score(data), "fault_label", training.PROBABILITY).first()["roc_auc"] for m in (whole, fitted)]
    assert min(areas) > 0.7
    models.save_model(spark, fitted, str(tmp_path / "parts"))
    again = models.load_model(spark, str(tmp_path / "parts"))
    assert again.model.trees == fitted.model.trees
    assert again.score(data).exceptAll(scored).isEmpty()


def test_class_gate(data):
    normal = data.filter("fault_label = 0")
    ready = training.class_gate(data, data).first()
    assert ready["status"] == "ready" and ready["reason"] is None and ready["training_fault_rows"] == 150
    assert training.class_gate(normal, data).first()["reason"] == "training data lacks a class"
    assert training.class_gate(data, normal.limit(0)).first()["status"] == training.SKIPPED


def test_deployable_model(spark):
    rows = [("a", "completed", False), ("b", "completed", True), ("c", "completed_with_warning", True)]
    metrics = spark.createDataFrame(rows, "model string, status string, is_tuned boolean")
    assert training.select_deployable(metrics).first()["model"] == "b"
    assert training.select_deployable(metrics.filter("model = 'c'")).isEmpty()


def test_saved_models_score_the_same(spark, data, tmp_path):
    for fitted in (
        training.train_logistic(data, ["a", "b"]),
        training.train_forest(data.filter("fault_label = 0"), ["a"]),
    ):
        path = str(tmp_path / fitted.name)
        models.save_model(spark, fitted, path)
        loaded = models.load_model(spark, path)
        assert loaded.features == fitted.features and loaded.status == fitted.status
        assert loaded.score(data).exceptAll(fitted.score(data)).isEmpty()


def test_metric_rows_are_appended(spark, tmp_path):
    path = str(tmp_path / "metrics")
    models.append_metrics(spark, path, "a", {"pr_auc": 0.5, "roc_auc": None})
    models.append_metrics(spark, path, "b", {"pr_auc": 1})
    rows = {(r["model"], r["metric"]): r["value"] for r in spark.read.parquet(path).collect()}
    assert rows == {("a", "pr_auc"): 0.5, ("a", "roc_auc"): None, ("b", "pr_auc"): 1.0}


def test_contract_keeps_unusable_rows_apart(data):
    fitted = training.train_logistic(data, ["a", "b"])
    scored, rejected = training.score_with_contract(data, fitted)
    assert scored.count() + rejected.count() == data.count()
    assert rejected.filter(F.col("b").isNotNull()).isEmpty()
    with pytest.raises(ContractError):
        training.score_with_contract(data.drop("a"), fitted)


def test_stream_scores_equal_batch_scores(spark, data, tmp_path):
    fitted = training.train_logistic(data, ["a", "b"])
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    data.write.parquet(source)
    stream = spark.readStream.schema(data.schema).parquet(source)
    score_stream(stream, fitted, out, str(tmp_path / "state"))
    batch, rejected = training.score_with_contract(data, fitted)
    routed = spark.read.parquet(out)
    streamed = routed.filter("route = 'accepted'")
    assert streamed.count() == batch.count()
    assert {r["id"] for r in routed.filter("route = 'rejected'").collect()} == {r["id"] for r in rejected.collect()}
    assert routed.filter(f"route = 'rejected' AND {training.PROBABILITY} IS NOT NULL").isEmpty()
    assert streamed.select("id", training.PREDICTION).exceptAll(batch.select("id", training.PREDICTION)).isEmpty()


ROLES = SeriesRoles(
    time="timestamp", seq=("seq",), machine=("machine_id",), analog=COMPRESSOR_ANALOG, flags=COMPRESSOR_FLAGS
)
WINDOWS = (FaultWindow("F1", "2024-01-01 00:20:00", "2024-01-01 00:25:00"),)


def compressor(spark, rows=400):
    base = spark.range(rows).select(
        F.col("id").alias("seq"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 10).alias("timestamp"),
        F.lit("m1").alias("machine_id"),
    )
    faulty = F.col("seq").between(120, 150).cast("double")
    columns = {n: F.sin(F.col("seq") * (i + 1)) + faulty * 3 for i, n in enumerate(COMPRESSOR_ANALOG)}
    columns |= {n: ((F.col("seq") + i) % 2).cast("double") for i, n in enumerate(COMPRESSOR_FLAGS)}
    return base.withColumns(columns)


def test_features_need_one_shuffle_and_one_window(spark):
    plan = with_features(compressor(spark), ROLES, gap="gap")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1 and plan.count("Exchange") == 1 and plan.count("Sort [") == 1
    assert "Python" not in plan


def test_from_readings_to_models(spark, tmp_path):
    raw = compressor(spark)
    broken = raw.limit(1).withColumn("timestamp", F.lit(None).cast("timestamp"))
    bronze = raw.unionByName(raw.filter("seq % 50 = 0")).unionByName(broken)
    audit = medallion.build(spark, bronze, str(tmp_path), ROLES, WINDOWS, chronological=False)
    rows = {r["split"]: r for r in audit.collect()}
    assert sum(r["row_count"] for r in rows.values()) == 400
    ends = splits.split_sizes(31)
    assert rows["train"]["fault_rows"] == ends[0]
    assert medallion.quarantined(spark, str(tmp_path / "judged")).count() == 1
    assert medallion.silver(spark, str(tmp_path / "judged")).columns == bronze.columns
    features = spark.read.parquet(str(tmp_path / "features"))
    # 15 sensors, the gap, 40 made from sensors and 5 from the time.
    from gaugeworks.operators.contracts import feature_columns

    assert len(feature_columns(features, features, excluded=["seq"])) == 61
    metrics = spark.read.parquet(str(tmp_path / "quality"))
    values = {r["metric_name"]: r["metric_value"] for r in metrics.collect()}
    assert values["total_rows"] == 409 and values["null_timestamp_rows"] == 1
    small = [{"trees": 5, "depth": 4, "leaf": 2}]
    compared = training_flow.run(spark, str(tmp_path / "splits"), str(tmp_path), ROLES, small)
    found = {r["model"]: r for r in compared.collect()}
    assert set(found) == {"logistic_regression", "random_forest", "feedforward_network", "tuned_random_forest"}
    chosen = spark.read.parquet(str(tmp_path / "deployment")).first()
    assert (chosen["search_status"], chosen["model"]) == ("ready", "tuned_random_forest")
    assert models.load_model(spark, str(tmp_path / "models/deployed")).name == "tuned_random_forest"
    halves = spark.read.parquet(str(tmp_path / "thresholds")).filter("threshold = 0.5")
    assert {r["model"]: r["tp"] for r in halves.collect()} == {name: r["tp"] for name, r in found.items()}
    assert all(not math.isnan(r["roc_auc"]) for r in found.values())
    assert found["random_forest"]["roc_auc"] > 0.8


def test_fallbacks_are_not_deployed(spark, tmp_path):
    rows = spark.createDataFrame([(0, 1.0), (0, 2.0)], "fault_label int, a double")
    constant = training.train_logistic(rows, ["a"], "fault_label")
    found = training_flow.deployment(spark, [constant], training.class_gate(rows, rows))
    found.write.parquet(str(tmp_path / "deployment"))
    chosen = spark.read.parquet(str(tmp_path / "deployment")).first()
    assert (chosen["model"], chosen["search_status"]) == (None, training.SKIPPED)
