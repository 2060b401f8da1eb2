from __future__ import annotations

import random

import pytest

from gaugeworks.operators import evaluation as E


def pairs(spark, rows):
    return spark.createDataFrame([(int(y), float(p)) for y, p in rows], "label int, probability double")


def brute_roc(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return wins / (len(pos) * len(neg))


def brute_ap(rows):
    total, area, last = sum(y for y, _ in rows), 0.0, 0.0
    for t in sorted({p for _, p in rows}, reverse=True):
        chosen = [y for y, p in rows if p >= t]
        recall, precision = sum(chosen) / total, sum(chosen) / len(chosen)
        area += (recall - last) * precision
        last = recall
    return area


def test_one_fault_among_many(spark):
    rows = [(0, 0.02)] * 1 + [(0, 0.4 + i / 100) for i in range(32)] + [(1, 0.1), (0, 0.01)]
    found = E.ranking_scores(pairs(spark, rows)).first()
    assert found["roc_auc"] == pytest.approx(2 / 34)
    assert found["pr_auc"] == pytest.approx(1 / 33)


def test_all_predicted_normal(spark):
    rows = [(0, 0.1)] * 34 + [(1, 0.2)]
    row = E.with_scores(E.confusion_matrix(pairs(spark, rows))).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (34, 0, 1, 0)
    assert row["accuracy"] == pytest.approx(0.9714285714285714)
    assert row["precision"] == row["recall"] == row["f1"] == 0.0


def test_recorded_threshold_rows(spark):
    rows = [(1, 0.3), (0, 0.02)] + [(0, 0.0)] * 33
    found = {r["threshold"]: r for r in E.threshold_table(pairs(spark, rows)).collect()}
    assert (found[0.01]["tp"], found[0.01]["fp"], found[0.01]["precision"]) == (1, 1, 0.5)
    assert found[0.01]["f1"] == pytest.approx(2 / 3)
    assert (found[0.05]["tp"], found[0.05]["fp"], found[0.05]["fn"], found[0.05]["tn"]) == (1, 0, 0, 34)
    assert len(found) == 9


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("scores_per_range", [10, 10**9])
def test_areas_equal_brute_force(spark, seed, scores_per_range):
    rng = random.Random(seed)
    steps = rng.choice([5, 50, 10_000])
    rows = [(rng.random() < 0.2, rng.randrange(steps) / steps) for _ in range(300)]
    found = E.ranking_scores(pairs(spark, rows), scores_per_range=scores_per_range).first()
    assert found["roc_auc"] == pytest.approx(brute_roc(rows), abs=1e-12)
    assert found["pr_auc"] == pytest.approx(brute_ap(rows), abs=1e-12)


def test_one_class_has_no_area(spark):
    found = E.ranking_scores(pairs(spark, [(0, 0.1), (0, 0.2)])).first()
    assert found["roc_auc"] is None and found["pr_auc"] is None
    assert not E.has_both_classes(pairs(spark, [(0, 0.1)])).first()["both_classes"]


def test_empty_input(spark):
    empty = pairs(spark, [(0, 0.1)]).limit(0)
    row = E.with_scores(E.confusion_matrix(empty)).first()
    assert (row["tn"], row["tp"], row["accuracy"]) == (0, 0, 0.0)
    assert E.ranking_scores(empty).first()["roc_auc"] is None


def test_models_are_kept_apart(spark):
    rows = [("a", 1, 0.9), ("a", 0, 0.1), ("b", 1, 0.1), ("b", 0, 0.9), ("c", 0, 0.5)]
    df = spark.createDataFrame(rows, "model string, label int, probability double")
    found = {r["model"]: r for r in E.compare_models(df).collect()}
    assert found["a"]["roc_auc"] == 1.0 and found["b"]["roc_auc"] == 0.0 and found["c"]["roc_auc"] is None


def test_agreement(spark):
    left = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "id long, prediction int")
    right = spark.createDataFrame([(1, 0), (2, 0), (4, 1)], "id long, prediction int")
    row = E.prediction_agreement(left, right, ["id"]).first()
    assert (row["compared_rows"], row["same_rows"], row["match_rate"]) == (2, 1, 0.5)


def test_thresholds_do_not_repeat_rows(spark):
    plan = E.threshold_table(pairs(spark, [(0, 0.1)]))._jdf.queryExecution().executedPlan().toString()
    scan_side = plan[plan.index("Exchange"):]
    assert "Generate" not in scan_side and "Expand" not in scan_side and "Join" not in plan
