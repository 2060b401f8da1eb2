"""Evaluation metrics, model preparation, training and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import (
    EV,
    LABELLED_SQL,
    ONE_MODEL_SQL,
    SCORES_SQL,
    SPLIT_SQL,
    WIDE,
    WIDE_COLUMNS,
    Registry,
    events,
    labelled,
    one_model,
    rounded,
    scores,
    table,
    wide,
)
from checks.io_checks import COMPARED_SQL, compared
from checks.series_checks import CHRONO_SQL
from checks.io_checks import text_per_user
from gaugeworks.operators import contracts, evaluation, sequence, splits, training
from gaugeworks.operators.features import with_features
from gaugeworks.sources import files, models
from gaugeworks.sources.scratch import scratch_path, written

checks = Registry()

# --- evaluation ----------------------------------------------------------------------------

MATRIX_SQL = f"""
SELECT count(*) FILTER (label = 0 AND probability < 0.1) AS tn, count(*) FILTER (label = 0 AND probability >= 0.1) AS fp,
       count(*) FILTER (label = 1 AND probability < 0.1) AS fn, count(*) FILTER (label = 1 AND probability >= 0.1) AS tp
FROM ({ONE_MODEL_SQL})"""


@checks.add("met1_confusion_matrix", MATRIX_SQL)
def _(spark, sf_dir):
    return evaluation.confusion_matrix(one_model(spark, sf_dir), threshold=0.1)


@checks.add("met2_accuracy", f"SELECT round((tp + tn)::DOUBLE / (tn + fp + fn + tp), 6) AS accuracy FROM ({MATRIX_SQL})")
def _(spark, sf_dir):
    matrix = evaluation.confusion_matrix(one_model(spark, sf_dir), threshold=0.1)
    return evaluation.with_scores(matrix).select(*rounded("accuracy"))


@checks.add(
    "met3_precision_recall_f1",
    f"""SELECT round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 6) AS precision,
               round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 6) AS recall,
               round(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM ({MATRIX_SQL})""",
)
def _(spark, sf_dir):
    matrix = evaluation.confusion_matrix(one_model(spark, sf_dir), threshold=0.1)
    return evaluation.with_scores(matrix).select(*rounded("precision", "recall", "f1"))


@checks.add("met4_both_classes", f"SELECT model, count(DISTINCT label) = 2 AS both_classes FROM ({SCORES_SQL}) GROUP BY model")
def _(spark, sf_dir):
    return evaluation.has_both_classes(scores(spark, sf_dir), models=["model"])


@checks.add(
    "met4_single_class_gate",
    f"""SELECT split, CASE WHEN count(DISTINCT fault_label) = 2 THEN 1 ELSE 0 END AS scored FROM ({CHRONO_SQL}) GROUP BY split""",
)
def _(spark, sf_dir):
    split = splits.chronological_split(labelled(spark, sf_dir), "ts")
    judged = split.withColumn("probability", F.least(F.col("value") / 500.0, F.lit(1.0)))
    found = evaluation.ranking_scores(judged, "fault_label", "probability", ["split"])
    return found.select("split", F.col("roc_auc").isNotNull().cast("int").alias("scored"))


@checks.add("met5_roc_auc", f"SELECT model, roc_auc FROM ({COMPARED_SQL})")
def _(spark, sf_dir):
    return evaluation.ranking_scores(scores(spark, sf_dir), models=["model"]).select("model", *rounded("roc_auc"))


@checks.add("met5_roc_auc_over_ranges", f"SELECT model, roc_auc FROM ({COMPARED_SQL})")
def _(spark, sf_dir):
    found = evaluation.ranking_scores(scores(spark, sf_dir), models=["model"], scores_per_range=500)
    return found.select("model", *rounded("roc_auc"))


@checks.add("met6_average_precision", f"SELECT model, pr_auc FROM ({COMPARED_SQL})")
def _(spark, sf_dir):
    return evaluation.ranking_scores(scores(spark, sf_dir), models=["model"]).select("model", *rounded("pr_auc"))


@checks.add("met6_average_precision_over_ranges", f"SELECT model, pr_auc FROM ({COMPARED_SQL})")
def _(spark, sf_dir):
    found = evaluation.ranking_scores(scores(spark, sf_dir), models=["model"], scores_per_range=500)
    return found.select("model", *rounded("pr_auc"))


DOCUMENT_SQL = """
WITH s AS (SELECT quality AS label, n_chars::DOUBLE AS score FROM labels JOIN documents USING (doc_id)),
g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM s GROUP BY score),
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(pos + neg) OVER (ORDER BY score DESC) AS n FROM g)
SELECT round(sum(neg * (tp - pos / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)), 6) AS roc_auc,
       round(sum(pos::DOUBLE * tp / n) / sum(pos), 6) AS pr_auc FROM c
"""


@checks.add("met5_met6_document_length", DOCUMENT_SQL)
def _(spark, sf_dir):
    joined = table(spark, sf_dir, "labels").join(
        table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score")), "doc_id"
    )
    return evaluation.ranking_scores(joined, "quality", "score").select(*rounded("roc_auc", "pr_auc"))


THRESHOLD_SQL = f"""
WITH t(threshold) AS (VALUES (0.01::DOUBLE), (0.02), (0.05), (0.10), (0.15), (0.20), (0.25), (0.30), (0.50)),
c AS (SELECT threshold, count(*) FILTER (label = 1 AND probability >= threshold) AS tp,
             count(*) FILTER (label = 0 AND probability >= threshold) AS fp,
             count(*) FILTER (label = 1 AND probability < threshold) AS fn,
             count(*) FILTER (label = 0 AND probability < threshold) AS tn
      FROM ({ONE_MODEL_SQL}) s, t GROUP BY threshold)
SELECT threshold, round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 6) AS recall,
       round(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, tp, fp, fn, tn FROM c
"""


@checks.add("met7_threshold_table", THRESHOLD_SQL)
def _(spark, sf_dir):
    found = evaluation.threshold_table(one_model(spark, sf_dir))
    return found.select("threshold", *rounded("precision", "recall", "f1"), "tp", "fp", "fn", "tn")


@checks.add(
    "met8_predicted_volumes",
    f"""SELECT threshold, tp + fp AS predicted_faults FROM ({THRESHOLD_SQL})
        WHERE threshold IN (0.01, 0.02, 0.05, 0.10, 0.20, 0.50)""",
)
def _(spark, sf_dir):
    return evaluation.predicted_volumes(one_model(spark, sf_dir))


RANGE_SQL = f"""SELECT round(min(probability), 9) AS min_probability, round(median(probability), 9) AS median_probability,
                       round(max(probability), 9) AS max_probability FROM ({ONE_MODEL_SQL})"""
RANGE = ("min_probability", "median_probability", "max_probability")


@checks.add("met9_probability_range", RANGE_SQL)
def _(spark, sf_dir):
    return evaluation.probability_range(one_model(spark, sf_dir)).select(*rounded(*RANGE, digits=9))


@checks.add("met9_probability_range_by_brackets", RANGE_SQL)
def _(spark, sf_dir):
    return evaluation.probability_range(one_model(spark, sf_dir), leaf_rows=0).select(*rounded(*RANGE, digits=9))


@checks.add(
    "met10_outcome_counts",
    f"""SELECT label, CASE WHEN probability >= 0.1 THEN 1 ELSE 0 END AS prediction, count(*) AS row_count
        FROM ({ONE_MODEL_SQL}) GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    judged = one_model(spark, sf_dir).withColumn("prediction", (F.col("probability") >= 0.1).cast("int"))
    return evaluation.outcome_counts(judged)


@checks.add("met11_model_comparison", COMPARED_SQL)
def _(spark, sf_dir):
    return compared(spark, sf_dir)


@checks.add("met11_model_comparison_over_ranges", COMPARED_SQL)
def _(spark, sf_dir):
    return compared(spark, sf_dir, scores_per_range=700)


AGREEMENT_SQL = f"""
WITH p AS (SELECT event_id, model, probability >= 0.25 AS hit FROM ({SCORES_SQL}))
SELECT count(*) AS compared_rows, count(*) FILTER (a.hit = b.hit) AS same_rows,
       round(count(*) FILTER (a.hit = b.hit)::DOUBLE / count(*), 6) AS match_rate
FROM p a JOIN p b USING (event_id) WHERE a.model = 'a' AND b.model = 'b'
"""


@checks.add("met12_prediction_agreement", AGREEMENT_SQL)
def _(spark, sf_dir):
    judged = scores(spark, sf_dir).withColumn("prediction", (F.col("probability") >= 0.25).cast("int"))
    first, second = (judged.filter(F.col("model") == name) for name in "ab")
    return evaluation.prediction_agreement(first, second, ["event_id"]).withColumn("match_rate", F.round("match_rate", 6))


@checks.add(
    "jn3_aligned_predictions",
    f"""SELECT a.event_id, a.probability AS first, round(b.probability, 6) AS second
        FROM ({SCORES_SQL}) a JOIN ({SCORES_SQL}) b USING (event_id) WHERE a.model = 'a' AND b.model = 'b'""",
)
def _(spark, sf_dir):
    judged = scores(spark, sf_dir)
    first = judged.filter("model = 'a'").select("event_id", F.col("probability").alias("first"))
    second = judged.filter("model = 'b'").select("event_id", F.round("probability", 6).alias("second"))
    return first.join(second, "event_id")


LATENCY_SQL = """
SELECT round(avg(value), 6) AS mean_latency_ms, round(quantile_cont(value, 0.95), 6) AS p95_latency_ms,
       round(sum(value) / sum(user_id + 1), 6) AS latency_per_row_ms,
       round(sum(user_id + 1) * 1000.0::DOUBLE / sum(value), 4) AS rows_per_second FROM events
"""


def latencies(spark, sf_dir, **options):
    batches = events(spark, sf_dir).withColumn("batch_rows", F.col("user_id") + 1)
    found = evaluation.latency_summary(batches, "value", "batch_rows", **options)
    return found.select(
        *rounded("mean_latency_ms", "p95_latency_ms", "latency_per_row_ms"), *rounded("rows_per_second", digits=4)
    )


@checks.add("met13_latency_summary", LATENCY_SQL)
def _(spark, sf_dir):
    return latencies(spark, sf_dir)


@checks.add("met13_latency_summary_by_brackets", LATENCY_SQL)
def _(spark, sf_dir):
    return latencies(spark, sf_dir, leaf_rows=0)


@checks.add(
    "met13_artifact_size",
    """SELECT count(DISTINCT user_id) AS files, sum(length(event_id::VARCHAR) + 1)::BIGINT AS bytes FROM events""",
)
def _(spark, sf_dir):
    return files.artifact_size(spark, text_per_user(spark, sf_dir))


@checks.add(
    "met14_class_distribution",
    f"""SELECT split, fault_label::VARCHAR AS class, count(*) AS row_count FROM ({SPLIT_SQL}) GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    split = splits.stratified_split(labelled(spark, sf_dir), "fault_label", ["event_id"])
    maps = evaluation.class_distribution(split, "fault_label", ["split"])
    return maps.select("split", F.explode("class_distribution").alias("class", "row_count"))


# --- preparation ---------------------------------------------------------------------------

PARTS_SQL = f"SELECT *, {WIDE_COLUMNS} FROM ({SPLIT_SQL})"


def split_wide(spark, sf_dir):
    split = splits.stratified_split(labelled(spark, sf_dir), "fault_label", ["event_id"])
    return wide(split)


IMPUTED = ", ".join(
    f"coalesce({n}, (SELECT coalesce(median({n}), 0) FROM parts WHERE split = 'train')) AS {n}" for n in WIDE
)
IMPUTED_SQL = f"WITH parts AS ({PARTS_SQL}) SELECT event_id, split, {IMPUTED} FROM parts"


@checks.add("ml1_median_imputation", IMPUTED_SQL)
def _(spark, sf_dir):
    data = split_wide(spark, sf_dir)
    preparation = training.fit_preparation(data.filter("split = 'train'"), WIDE)
    return preparation.prepared(data).select("event_id", "split", *WIDE)


@checks.add(
    "ml2_standardization",
    f"""WITH filled AS ({IMPUTED_SQL}), t AS (SELECT * FROM filled WHERE split = 'train')
        SELECT event_id, {', '.join(
            f"round(({n} - (SELECT avg({n}) FROM t)) / (SELECT stddev_pop({n}) FROM t), 6) AS {n}" for n in WIDE)}
        FROM filled""",
)
def _(spark, sf_dir):
    data = split_wide(spark, sf_dir)
    preparation = training.fit_preparation(data.filter("split = 'train'"), WIDE, scale=True)
    return preparation.prepared(data).select("event_id", *rounded(*WIDE))


@checks.add(
    "ml3_balanced_weights",
    f"""SELECT event_id, round((count(*) OVER ())::DOUBLE / (2 * count(*) OVER (PARTITION BY fault_label)), 6) AS class_weight
        FROM ({LABELLED_SQL})""",
)
def _(spark, sf_dir):
    data = labelled(spark, sf_dir)
    counts = contracts.class_counts(data, "fault_label")
    weighted = training.with_balanced_weight(data, "fault_label", counts)
    return weighted.select("event_id", *rounded("class_weight"))


@checks.add(
    "ml7_single_class_fallback",
    """SELECT event_id, 0.0::DOUBLE AS fault_probability, 0 AS fault_prediction, 'completed_with_warning' AS status
       FROM events""",
)
def _(spark, sf_dir):
    data = events(spark, sf_dir).withColumn("fault_label", F.lit(0))
    model = training.train_forest(data, ["value"])
    scored = model.score(data).withColumn("status", F.lit(model.status))
    return scored.select("event_id", training.PROBABILITY, training.PREDICTION, "status")


@checks.add(
    "ml10_class_gate",
    f"""SELECT count(*) FILTER (split = 'train' AND fault_label = 0) AS training_normal_rows,
               count(*) FILTER (split = 'train' AND fault_label = 1) AS training_fault_rows,
               count(*) FILTER (split = 'test' AND fault_label = 0) AS validation_normal_rows,
               count(*) FILTER (split = 'test' AND fault_label = 1) AS validation_fault_rows,
               'skipped_missing_class' AS status, 'validation data lacks a class' AS reason FROM ({CHRONO_SQL})""",
)
def _(spark, sf_dir):
    split = splits.chronological_split(labelled(spark, sf_dir), "ts")
    return training.class_gate(split.filter("split = 'train'"), split.filter("split = 'test'"))


@checks.add(
    "ml13_deployable_model",
    f"""SELECT model, status, is_tuned, pr_auc FROM (
          SELECT model, CASE WHEN model = 'b' THEN 'completed_with_warning' ELSE 'completed' END AS status,
                 model = 'b' AS is_tuned, pr_auc FROM ({COMPARED_SQL}))
        WHERE status = 'completed' ORDER BY is_tuned DESC, model LIMIT 1""",
)
def _(spark, sf_dir):
    constant = F.col("model") == "b"
    metrics = compared(spark, sf_dir).select(
        "model",
        F.when(constant, training.COMPLETED_WITH_WARNING).otherwise(training.COMPLETED).alias("status"),
        constant.alias("is_tuned"),
        "pr_auc",
    )
    return training.select_deployable(metrics)


# --- training ------------------------------------------------------------------------------

FEATURES = (
    "value",
    "value_delta",
    "value_rolling_mean_5m",
    "value_rolling_std_5m",
    "value_rolling_min_5m",
    "value_rolling_max_5m",
    "hour",
    "minute",
    "day_of_week",
    "hour_sin",
    "hour_cos",
    sequence.GAP,
)


def training_parts(spark, sf_dir):
    featured = written(with_features(labelled(spark, sf_dir), EV, gap=sequence.GAP), "features")
    split = written(splits.stratified_split(featured, "fault_label", ["event_id"]), "split")
    return tuple(split.filter(F.col("split") == part).drop("split") for part in splits.SPLITS)


VALIDATION_SQL = f"SELECT event_id, fault_label, true AS in_range, true AS consistent FROM ({SPLIT_SQL}) WHERE split = 'validation'"


def judged(model, data):
    """Every row of the data with a probability, and a prediction that follows from it."""
    found, p = scored(model, data), F.col(training.PROBABILITY)
    return found.select(
        "event_id", "fault_label", p.between(0.0, 1.0).alias("in_range"),
        ((p >= 0.5).cast("int") == F.col(training.PREDICTION)).alias("consistent"),
    )


def scored(model, data):
    return model.score(data).select("event_id", "fault_label", training.PROBABILITY, training.PREDICTION)


@checks.add("ml4_logistic_regression", VALIDATION_SQL)
def _(spark, sf_dir):
    train, validation, _ = training_parts(spark, sf_dir)
    return judged(training.train_logistic(train, FEATURES), validation)


@checks.add("ml5_random_forest", VALIDATION_SQL)
def _(spark, sf_dir):
    train, validation, _ = training_parts(spark, sf_dir)
    return judged(training.train_forest(train, FEATURES), validation)


@checks.add("ml6_feedforward_network", VALIDATION_SQL)
def _(spark, sf_dir):
    train, validation, _ = training_parts(spark, sf_dir)
    return judged(training.train_network(train, FEATURES), validation)


@checks.add(
    "con6_model_contract",
    f"""SELECT 12 AS recorded, 12 AS listed, 12 AS model_width, count(*) AS scored_rows
        FROM ({SPLIT_SQL}) WHERE split = 'validation'""",
)
def _(spark, sf_dir):
    train, validation, _ = training_parts(spark, sf_dir)
    fitted = training.train_logistic(train, FEATURES)
    contracts.check_model(len(FEATURES), fitted.features, fitted.model.numFeatures)
    return fitted.score(validation).agg(
        F.lit(len(FEATURES)).alias("recorded"),
        F.lit(len(fitted.features)).alias("listed"),
        F.lit(fitted.model.numFeatures).alias("model_width"),
        F.count("*").alias("scored_rows"),
    )


@checks.add(
    "ml8_fault_probability",
    f"""SELECT fault_label, count(*) AS scored_rows, true AS in_range, true AS ordered
        FROM ({SPLIT_SQL}) WHERE split = 'validation' GROUP BY fault_label""",
)
def _(spark, sf_dir):
    train, validation, _ = training_parts(spark, sf_dir)
    rows = training.train_logistic(train, FEATURES).score(validation)
    whole = evaluation.probability_range(rows, training.PROBABILITY)
    low, middle, high = F.col("min_probability"), F.col("median_probability"), F.col("max_probability")
    judged_range = whole.select(((low >= 0) & (high <= 1)).alias("in_range"), ((low <= middle) & (middle <= high)).alias("ordered"))
    counts = rows.groupBy("fault_label").agg(F.count(training.PROBABILITY).alias("scored_rows"))
    return counts.withColumn("one", F.lit(1)).join(judged_range.withColumn("one", F.lit(1)), "one").drop("one")


@checks.add(
    "ml9_forest_search",
    """SELECT *, true AS measured, true AS best_found
       FROM (VALUES (0, 80, 16, 1), (1, 80, 24, 2), (2, 100, NULL, 2)) AS t(candidate, trees, depth, leaf)""",
)
def _(spark, sf_dir):
    """The best candidate is the one of highest average precision, the first of equals."""
    train, validation, _ = training_parts(spark, sf_dir)
    result = training.search_forest(train, validation, FEATURES)
    best = max(result.trials, key=lambda trial: trial["pr_auc"])
    chosen = result.best.parameters == {"n_estimators": best["trees"], "max_depth": best["depth"], "min_samples_leaf": best["leaf"]}
    rows = [
        (i, t["trees"], t["depth"], t["leaf"], 0.0 < t["pr_auc"] <= 1.0 and 0.0 <= t["roc_auc"] <= 1.0, chosen)
        for i, t in enumerate(result.trials)
    ]
    return spark.createDataFrame(rows, "candidate int, trees int, depth int, leaf int, measured boolean, best_found boolean")


VALIDATION_COUNT = f"(SELECT count(*) FROM ({SPLIT_SQL}) WHERE split = 'validation')"


@checks.add(
    "ml11_saved_model",
    f"SELECT {VALIDATION_COUNT} AS compared_rows, {VALIDATION_COUNT} AS same_rows, 1.0::DOUBLE AS match_rate",
)
def _(spark, sf_dir):
    train, validation, _ = training_parts(spark, sf_dir)
    path = scratch_path(spark, "model")
    fitted = training.train_logistic(train, FEATURES)
    models.save_model(spark, fitted, path)
    before = scored(fitted, validation).select("event_id", F.col(training.PREDICTION).alias("prediction"))
    after = scored(models.load_model(spark, path), validation).select(
        "event_id", F.col(training.PREDICTION).alias("prediction")
    )
    return evaluation.prediction_agreement(before, after, ["event_id"])


@checks.add(
    "ml12_batch_scoring",
    f"""SELECT event_id, place > 1 AS accepted, CASE WHEN place > 1 THEN 'logistic_regression' END AS model_name
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM ({SPLIT_SQL}))
        WHERE split = 'test'""",
)
def _(spark, sf_dir):
    train, _, test = training_parts(spark, sf_dir)
    model = training.train_logistic(train, FEATURES)
    accepted, rejected = training.score_with_contract(test, model)
    consistent = (F.col(training.PROBABILITY) >= 0.5) == (F.col(training.PREDICTION) == 1)
    return accepted.select("event_id", consistent.alias("accepted"), "model_name").unionByName(
        rejected.select("event_id", F.lit(False).alias("accepted")), allowMissingColumns=True
    )
