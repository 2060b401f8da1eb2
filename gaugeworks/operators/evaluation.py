"""Evaluation of fault probabilities against labels.

Input is long: model columns (possibly none), a 0/1 label and a probability.
Everything is a conditional count except the two areas under curves, which
need the labels in score order.  Those first collapse equal scores, so a score
shared by many rows is one row afterwards, and then run cumulative sums over
balanced score ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.columns import at_threshold, ratio, ratio_or_zero, ref, refs
from gaugeworks.operators.quantiles import LEAF_ROWS, exact_quantiles
from gaugeworks.operators.ranges import (
    DEFAULT_ROWS_PER_RANGE,
    RANGE,
    OrderedRanges,
    from_earlier_ranges,
    join_range_offsets,
)
from gaugeworks.operators.shape import rows_from_wide
from gaugeworks.sources.scratch import written

# Thresholds of the comparison table and of the volume table.
THRESHOLDS = (0.01, 0.02, 0.05, 0.10, 0.15, 0.20, 0.25, 0.30, 0.50)
VOLUME_THRESHOLDS = (0.01, 0.02, 0.05, 0.10, 0.20, 0.50)
CELLS = ("tn", "fp", "fn", "tp")


def _confusion(label: Column, predicted: Column) -> dict[str, Column]:
    return {
        "tn": F.count_if((label == 0) & (predicted == 0)),
        "fp": F.count_if((label == 0) & (predicted == 1)),
        "fn": F.count_if((label == 1) & (predicted == 0)),
        "tp": F.count_if((label == 1) & (predicted == 1)),
    }


def _grouped(df: DataFrame, models: Sequence[str]):
    return df.groupBy(*refs(models)) if models else df.groupBy()


def confusion_matrix(
    df: DataFrame,
    label: str = "label",
    probability: str = "probability",
    threshold: float = 0.5,
    models: Sequence[str] = (),
) -> DataFrame:
    """tn, fp, fn, tp; all four cells even when empty."""
    cells = _confusion(ref(label), at_threshold(ref(probability), threshold))
    return _grouped(df, models).agg(*[count.alias(name) for name, count in cells.items()])


def precision_of(tp: Column, fp: Column) -> Column:
    return ratio_or_zero(tp, tp + fp)


def recall_of(tp: Column, fn: Column) -> Column:
    return ratio_or_zero(tp, tp + fn)


def f1_of(tp: Column, fp: Column, fn: Column) -> Column:
    return ratio_or_zero(2 * tp, 2 * tp + fp + fn)


def with_scores(matrix: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 next to the four cells; 0 where undefined."""
    tn, fp, fn, tp = (F.col(name) for name in CELLS)
    return matrix.withColumns(
        {
            "accuracy": ratio_or_zero(tp + tn, tn + fp + fn + tp),
            "precision": precision_of(tp, fp),
            "recall": recall_of(tp, fn),
            "f1": f1_of(tp, fp, fn),
        }
    )


def has_both_classes(df: DataFrame, label: str = "label", models: Sequence[str] = ()) -> DataFrame:
    kinds = (F.count_if(ref(label) == 0) > 0) & (F.count_if(ref(label) == 1) > 0)
    return _grouped(df, models).agg(kinds.alias("both_classes"))


def score_groups(df: DataFrame, label: str, probability: str, models: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score; rows without a score are left out."""
    return df.filter(ref(probability).isNotNull()).groupBy(*refs(models), ref(probability).alias("score")).agg(
        F.count_if(ref(label) == 1).alias("pos"),
        F.count_if(ref(label) == 0).alias("neg"),
    )


def ranking_curve(
    df: DataFrame,
    label: str = "label",
    probability: str = "probability",
    models: Sequence[str] = (),
    scores_per_range: int = DEFAULT_ROWS_PER_RANGE,
) -> DataFrame:
    """Distinct scores with ``tp_cum`` and ``n_cum``: positives and rows at or above the score."""
    groups = score_groups(df, label, probability, models)
    keys = refs(models)
    window = Window.partitionBy(*keys).orderBy(F.col("score").desc())
    frame = (Window.unboundedPreceding, Window.currentRow)
    if _distinct_scores(df, probability, models, scores_per_range) <= scores_per_range:
        over = window.rowsBetween(*frame)
        return groups.withColumns(
            {"tp_cum": F.sum("pos").over(over), "n_cum": F.sum(F.col("pos") + F.col("neg")).over(over)}
        )

    groups = written(groups, "scores")
    ranges = OrderedRanges.plan(groups, (*models, "score"), scores_per_range)
    tagged = groups.withColumn(RANGE, ranges.range_id)
    above = from_earlier_ranges(
        tagged,
        models,
        {"tp_above": F.sum("pos"), "n_above": F.sum(F.col("pos") + F.col("neg"))},
        descending=True,
    )
    over = Window.partitionBy(RANGE, *keys).orderBy(F.col("score").desc()).rowsBetween(*frame)
    local = tagged.withColumns(
        {"tp_in": F.sum("pos").over(over), "n_in": F.sum(F.col("pos") + F.col("neg")).over(over)}
    )
    zero = F.lit(0)
    return join_range_offsets(local, above, models).select(
        *keys,
        "score",
        "pos",
        "neg",
        (F.col("tp_in") + F.coalesce("tp_above", zero)).alias("tp_cum"),
        (F.col("n_in") + F.coalesce("n_above", zero)).alias("n_cum"),
    )


def _distinct_scores(df: DataFrame, probability: str, models: Sequence[str], limit: int) -> int:
    """Upper estimate of the distinct scores; the row count when that is small already."""
    rows = df.count()
    if rows <= limit:
        return rows
    key = F.struct(*refs(models), ref(probability)) if models else ref(probability)
    return int(df.agg(F.approx_count_distinct(F.xxhash64(key), 0.02)).first()[0] * 1.1)


def _areas() -> dict[str, Column]:
    """Aggregates over a ranking curve: ROC-AUC and average precision."""
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    beaten = neg * (F.col("tp_cum").cast("double") - pos / 2)
    step = pos * F.col("tp_cum").cast("double") / F.col("n_cum").cast("double")
    both = (F.sum("pos") > 0) & (F.sum("neg") > 0)
    return {
        "roc_auc": F.when(both, ratio(F.sum(beaten), F.sum(pos) * F.sum(neg))),
        "pr_auc": F.when(both, ratio(F.sum(step), F.sum(pos))),
    }


def ranking_scores(
    df: DataFrame,
    label: str = "label",
    probability: str = "probability",
    models: Sequence[str] = (),
    scores_per_range: int = DEFAULT_ROWS_PER_RANGE,
) -> DataFrame:
    """ROC-AUC (ties count one half) and average precision; null unless both classes occur."""
    curve = ranking_curve(df, label, probability, models, scores_per_range)
    return _grouped(curve, models).agg(*[area.alias(name) for name, area in _areas().items()])


def threshold_table(
    df: DataFrame,
    label: str = "label",
    probability: str = "probability",
    thresholds: Sequence[float] = THRESHOLDS,
    models: Sequence[str] = (),
) -> DataFrame:
    """Scores at several thresholds, from one pass: the rows are not repeated per threshold."""
    y, p = ref(label), ref(probability)
    hits = []
    for i, threshold in enumerate(thresholds):
        hits.append(F.count_if((y == 1) & (p >= F.lit(float(threshold)))).alias(f"tp_{i}"))
        hits.append(F.count_if((y == 0) & (p >= F.lit(float(threshold)))).alias(f"fp_{i}"))
    wide = _grouped(df, models).agg(
        F.count_if((y == 1) & p.isNotNull()).alias("positives"),
        F.count_if((y == 0) & p.isNotNull()).alias("negatives"),
        *hits,
    )
    rows = []
    for i, threshold in enumerate(thresholds):
        tp, fp = F.col(f"tp_{i}"), F.col(f"fp_{i}")
        fn = F.col("positives") - tp
        rows.append(
            {
                "threshold": F.lit(float(threshold)),
                "precision": precision_of(tp, fp),
                "recall": recall_of(tp, fn),
                "f1": f1_of(tp, fp, fn),
                "tp": tp,
                "fp": fp,
                "fn": fn,
                "tn": F.col("negatives") - fp,
            }
        )
    return rows_from_wide(wide, rows, models)


def predicted_volumes(
    df: DataFrame, probability: str = "probability", thresholds: Sequence[float] = VOLUME_THRESHOLDS
) -> DataFrame:
    wide = df.agg(
        *[F.count_if(ref(probability) >= F.lit(float(t))).alias(f"n_{i}") for i, t in enumerate(thresholds)]
    )
    return rows_from_wide(
        wide,
        [
            {"threshold": F.lit(float(t)), "predicted_faults": F.col(f"n_{i}")}
            for i, t in enumerate(thresholds)
        ],
    )


def probability_range(df: DataFrame, probability: str = "probability", leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Smallest, median and largest probability."""
    median = exact_quantiles(df, {probability: [0.5]}, leaf_rows=leaf_rows)[probability][0]
    return df.agg(
        F.min(ref(probability)).alias("min_probability"),
        F.lit(median).cast("double").alias("median_probability"),
        F.max(ref(probability)).alias("max_probability"),
    )


def outcome_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(ref(label), ref(prediction)).agg(F.count("*").alias("row_count"))


def compare_models(
    df: DataFrame,
    label: str = "label",
    probability: str = "probability",
    model: str = "model",
    threshold: float = 0.5,
    scores_per_range: int = DEFAULT_ROWS_PER_RANGE,
) -> DataFrame:
    """All metrics of every model, one row each.

    The cells of the confusion matrix are sums over the ranking curve, so the
    scores are read once.
    """
    curve = ranking_curve(df, label, probability, [model], scores_per_range)
    hit = F.col("score") >= F.lit(float(threshold))

    def rows(count: str, where: Column) -> Column:
        return F.sum(F.when(where, F.col(count)).otherwise(0))

    cells = {"tn": rows("neg", ~hit), "fp": rows("neg", hit), "fn": rows("pos", ~hit), "tp": rows("pos", hit)}
    measured = curve.groupBy(ref(model)).agg(
        *[value.alias(name) for name, value in {**cells, **_areas()}.items()]
    )
    return (
        with_scores(measured)
        .withColumn("threshold", F.lit(float(threshold)))
        .select(model, "threshold", "accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc", *CELLS)
    )


def prediction_agreement(first: DataFrame, second: DataFrame, keys: Sequence[str], prediction: str = "prediction") -> DataFrame:
    """Share of common rows on which two models predict the same class."""
    left = first.select(*refs(keys), ref(prediction).alias("__first"))
    right = second.select(*refs(keys), ref(prediction).alias("__second"))
    same = F.col("__first") == F.col("__second")
    return (
        left.join(right, list(keys))
        .agg(F.count("*").alias("compared_rows"), F.count_if(same).alias("same_rows"))
        .withColumn("match_rate", ratio_or_zero(F.col("same_rows"), F.col("compared_rows")))
    )


def latency_summary(
    df: DataFrame, latency_ms: str, batch_rows: str, leaf_rows: int = LEAF_ROWS
) -> DataFrame:
    """Mean and p95 latency, time per row and throughput of a table of timed batches."""
    p95 = exact_quantiles(df, {latency_ms: [0.95]}, leaf_rows=leaf_rows)[latency_ms][0]
    total, rows = F.sum(ref(latency_ms)), F.sum(ref(batch_rows))
    return df.agg(
        F.avg(ref(latency_ms)).alias("mean_latency_ms"),
        F.lit(p95).cast("double").alias("p95_latency_ms"),
        ratio(total, rows).alias("latency_per_row_ms"),
        ratio(rows * 1000.0, total).alias("rows_per_second"),
    )


def class_distribution(df: DataFrame, label: str = "label", groups: Sequence[str] = ()) -> DataFrame:
    """Map from class to row count, per group."""
    counted = df.groupBy(*refs(groups), ref(label).cast("string").alias("__class")).agg(
        F.count("*").alias("__n")
    )
    pairs = F.sort_array(F.collect_list(F.struct("__class", "__n")))
    return _grouped(counted.filter(F.col("__class").isNotNull()), groups).agg(
        F.map_from_entries(pairs).alias("class_distribution")
    )
