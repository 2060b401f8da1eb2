"""Preparation, training and scoring with ``pyspark.ml``.

Nothing leaves the cluster but medians, means, class counts and metrics.
Imputation and scaling are literals in a projection, fitted on the training
rows only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.base import Model
from pyspark.ml.classification import (
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassificationModel,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.columns import at_threshold, finite_or_null, ref
from gaugeworks.operators import forests
from gaugeworks.operators.contracts import ContractError, check_model, class_counts, require_columns, with_validity
from gaugeworks.operators.evaluation import ranking_scores
from gaugeworks.operators.quantiles import exact_medians
from gaugeworks.sources.scratch import drop_written, scratch_path, written

VECTOR = "features"
WEIGHT = "class_weight"
PROBABILITY = "fault_probability"
PREDICTION = "fault_prediction"
COMPLETED = "completed"
COMPLETED_WITH_WARNING = "completed_with_warning"
SKIPPED = "skipped_missing_class"
READY = "ready"
TUNED_FOREST = "tuned_random_forest"
DEAL = "__deal"
VOTES = "__votes"
# Spark's trees cannot grow deeper.
DEEPEST_TREE = 30
# Nodes of the trees that the driver loads at once, some 400 bytes each.
NODES_AT_ONCE = 1_000_000


@dataclass(frozen=True)
class Preparation:
    """Medians for missing values and, when scaling, means and spreads of the training rows."""

    features: tuple[str, ...]
    medians: Mapping[str, float]
    means: Mapping[str, float] = field(default_factory=dict)
    spreads: Mapping[str, float] = field(default_factory=dict)

    def imputed(self, df: DataFrame) -> DataFrame:
        """Non-finite and missing values become the training median."""
        return df.withColumns(
            {
                name: F.coalesce(
                    finite_or_null(ref(name), df.schema[name].dataType).cast("double"),
                    F.lit(float(self.medians[name])),
                )
                for name in self.features
            }
        )

    def prepared(self, df: DataFrame) -> DataFrame:
        filled = self.imputed(df)
        if not self.means:
            return filled
        return filled.withColumns(
            {
                name: (ref(name) - F.lit(float(self.means[name]))) / F.lit(float(self.spreads[name]))
                for name in self.features
            }
        )


def finite_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return df.withColumns({name: finite_or_null(ref(name), df.schema[name].dataType) for name in features})


def fit_preparation(train: DataFrame, features: Sequence[str], scale: bool = False) -> Preparation:
    """Exact medians (0 for a column without values); population mean and deviation when scaling."""
    names = tuple(features)
    medians = exact_medians(finite_features(train.select(*[ref(n) for n in names]), names), names)
    filled = Preparation(names, {name: 0.0 if value is None else value for name, value in medians.items()})
    if not scale:
        return filled
    moments = filled.imputed(train).agg(
        *[F.avg(ref(name)).alias(f"m{i}") for i, name in enumerate(names)],
        *[F.stddev_pop(ref(name)).alias(f"s{i}") for i, name in enumerate(names)],
    ).first()
    means = {name: moments[f"m{i}"] or 0.0 for i, name in enumerate(names)}
    spreads = {name: moments[f"s{i}"] or 1.0 for i, name in enumerate(names)}
    return Preparation(names, filled.medians, means, spreads)


def balanced_weights(counts: Mapping[int, int]) -> dict[int, float]:
    """``rows / (classes * rows of the class)``."""
    present = {group: n for group, n in counts.items() if n}
    total = sum(present.values())
    return {group: total / (len(present) * n) for group, n in present.items()}


def with_balanced_weight(df: DataFrame, label: str, counts: Mapping[int, int], name: str = WEIGHT) -> DataFrame:
    weight = F.lit(None).cast("double")
    for group, value in balanced_weights(counts).items():
        weight = F.when(ref(label) == group, F.lit(value)).otherwise(weight)
    return df.withColumn(name, weight)


@dataclass(frozen=True)
class ForestParts:
    """A forest of more nodes than the driver should hold: saved models of some of its trees each."""

    paths: tuple[str, ...]
    trees: tuple[int, ...]
    numFeatures: int

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability``, the mean over all trees, for the classes 0 and 1.

        One part is loaded at a time and its votes are written; the parts of a
        stream's plan are all loaded at once.
        """
        own = list(df.columns)
        held, before = df.withColumn(VOTES, F.lit(0.0)), None
        for path, trees in zip(self.paths, self.trees):
            voted = RandomForestClassificationModel.load(path).transform(held)
            votes = F.col(VOTES) + F.lit(float(trees)) * vector_to_array(F.col("probability"))[1]
            held = voted.select(*[ref(name) for name in own], votes.alias(VOTES))
            if not df.isStreaming:
                held = written(held, "votes")
                if before is not None:
                    drop_written(before)
                before = held
        share = F.col(VOTES) / F.lit(float(sum(self.trees)))
        return held.withColumn("probability", array_to_vector(F.array(1.0 - share, share))).drop(VOTES)


@dataclass(frozen=True)
class FaultModel:
    """A fitted model with what is needed to score: preparation, features, fallback class."""

    name: str
    preparation: Preparation
    model: Model | ForestParts | None = None
    constant: int | None = None
    parameters: Mapping[str, object] = field(default_factory=dict)

    @property
    def features(self) -> tuple[str, ...]:
        return self.preparation.features

    @property
    def status(self) -> str:
        return COMPLETED if self.constant is None else COMPLETED_WITH_WARNING

    def score(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        """Add fault probability and prediction; works on streams as well."""
        if self.constant is not None:
            return df.withColumns(
                {PROBABILITY: F.lit(float(self.constant)), PREDICTION: F.lit(self.constant)}
            )
        require_columns(df, self.features)
        check_model(len(self.features), self.features, self.model.numFeatures)
        # The input columns stay as they came: preparation happens on copies.
        copies = {f"__f{i}": ref(name) for i, name in enumerate(self.features)}
        original = list(df.columns)
        renamed = Preparation(
            tuple(copies),
            *[
                {f"__f{i}": values[name] for i, name in enumerate(self.features) if values}
                for values in (self.preparation.medians, self.preparation.means, self.preparation.spreads)
            ],
        )
        assembled = assemble(renamed.prepared(df.withColumns(copies)), renamed.features)
        scored = self.model.transform(assembled)
        probability = vector_to_array(F.col("probability"))[1]
        return scored.withColumn(PROBABILITY, probability).select(
            *[ref(name) for name in original],
            PROBABILITY,
            at_threshold(F.col(PROBABILITY), threshold).alias(PREDICTION),
        )


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=VECTOR).transform(df)


def constant_model(name: str, features: Sequence[str], counts: Mapping[int, int]) -> FaultModel | None:
    """Fallback when training holds one class only."""
    present = [group for group, n in counts.items() if n]
    if not present:
        raise ContractError("the training data has no labelled rows")
    if len(present) > 1:
        return None
    return FaultModel(name, Preparation(tuple(features), {f: 0.0 for f in features}), constant=present[0])


def _dealt(rows: DataFrame, preparation: Preparation) -> DataFrame:
    """Rows dealt evenly by their values: learners read them many times.

    The number of parts follows the session, never the number of rows.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn(DEAL, F.xxhash64(*[ref(name) for name in preparation.features]))
    return dealt.repartition(parts, DEAL).sortWithinPartitions(DEAL)


def _training_frame(
    train: DataFrame, preparation: Preparation, label: str, counts: Mapping[int, int]
) -> DataFrame:
    """Assembled rows, written once."""
    dealt = _dealt(with_balanced_weight(preparation.prepared(train), label, counts), preparation)
    frame = assemble(dealt, preparation.features).select(VECTOR, ref(label).cast("double").alias(label), WEIGHT)
    return written(frame, "training")


def _binned(
    train: DataFrame, preparation: Preparation, label: str, counts: Mapping[int, int], seed: int
) -> tuple[DataFrame, list[np.ndarray]]:
    """Rows for forests as blocks of bins, written once, and the cuts between the bins."""
    prepared = preparation.prepared(train).select(*[ref(name) for name in preparation.features], ref(label))
    weights = balanced_weights(counts)
    cuts = forests.feature_cuts(prepared, preparation.features, label, (weights[0], weights[1]), sum(counts.values()), seed)
    return forests.binned_blocks(_dealt(prepared, preparation), preparation.features, label, cuts), cuts


def _saved(spark: SparkSession, model: Model) -> str:
    path = scratch_path(spark, "stage")
    model.write().save(path)
    return path


def _without_summary(spark: SparkSession, model: Model) -> Model:
    """The model as saved: a fitted one carries a summary and with it the session, which not every state lets go to tasks."""
    return type(model).load(_saved(spark, model))


def train_logistic(
    train: DataFrame,
    features: Sequence[str],
    label: str = "fault_label",
    max_iterations: int = 1000,
    strength: float = 1.0,
    name: str = "logistic_regression",
) -> FaultModel:
    """Balanced logistic regression with an L2 penalty of ``strength`` (inverse, larger is weaker)."""
    counts = class_counts(train, label)
    fallback = constant_model(name, features, counts)
    if fallback is not None:
        return fallback
    preparation = fit_preparation(train, features, scale=True)
    penalty = 1.0 / (strength * sum(counts.values()))
    estimator = LogisticRegression(
        featuresCol=VECTOR,
        labelCol=label,
        weightCol=WEIGHT,
        maxIter=max_iterations,
        regParam=penalty,
        elasticNetParam=0.0,
        standardization=False,
    )
    model = _without_summary(train.sparkSession, estimator.fit(_training_frame(train, preparation, label, counts)))
    return FaultModel(name, preparation, model, parameters={"max_iter": max_iterations, "C": strength})


def train_forest(
    train: DataFrame,
    features: Sequence[str],
    label: str = "fault_label",
    trees: int = 100,
    depth: int | None = 20,
    leaf: int = 2,
    seed: int = 42,
    name: str = "random_forest",
) -> FaultModel:
    """Random forest with balanced class weights; no depth limit means Spark's own limit."""
    counts = class_counts(train, label)
    fallback = constant_model(name, features, counts)
    if fallback is not None:
        return fallback
    preparation = fit_preparation(train, features)
    blocks, cuts = _binned(train, preparation, label, counts, seed)
    weights = balanced_weights(counts)
    fitted = _fit_forest(blocks, cuts, sum(counts.values()), preparation, weights, trees, depth, leaf, seed, name)
    drop_written(blocks)
    return fitted


def _fit_forest(
    blocks: DataFrame,
    cuts: Sequence[np.ndarray],
    rows: int,
    preparation: Preparation,
    weights: Mapping[int, float],
    trees: int,
    depth: int | None,
    leaf: int,
    seed: int,
    name: str,
    nodes_at_once: int = NODES_AT_ONCE,
) -> FaultModel:
    """All trees, saved as models of about ``nodes_at_once`` nodes each."""
    spark = blocks.sparkSession
    deepest = DEEPEST_TREE if depth is None else min(depth, DEEPEST_TREE)
    plan = forests.ForestPlan(len(preparation.features), trees, deepest, leaf, (weights[0], weights[1]), seed)
    described = {"impurity": "gini", "featuresCol": VECTOR, "weightCol": WEIGHT, "maxDepth": deepest, "minInstancesPerNode": leaf, "seed": seed}
    paths, sizes = [], []
    step = forests.trees_at_once(rows, plan)
    for start in range(0, trees, step):
        grown = forests.grow_trees(blocks, rows, range(start, min(start + step, trees)), plan)
        # While a part is loaded, the driver holds every node of it twice.
        for part in _parts({tree: grown.size(tree) for tree in grown.crowns}, nodes_at_once // 2):
            paths.append(scratch_path(spark, "stage"))
            forests.save_forest(spark, grown, part, cuts, plan, described, paths[-1])
            sizes.append(len(part))
        drop_written(grown.nodes)
    if len(paths) == 1:
        model = RandomForestClassificationModel.load(paths[0])
    else:
        model = ForestParts(tuple(paths), tuple(sizes), len(preparation.features))
    parameters = {"n_estimators": trees, "max_depth": depth, "min_samples_leaf": leaf}
    return FaultModel(name, preparation, model, parameters=parameters)


def _parts(sizes: Mapping[int, int], most: int) -> list[list[int]]:
    """Trees in their order, in parts of at most so many nodes or one tree."""
    parts, filled = [], most
    for tree, size in sizes.items():
        if filled + size > most:
            parts.append([])
            filled = 0
        parts[-1].append(tree)
        filled += size
    return parts


def train_network(
    train: DataFrame,
    features: Sequence[str],
    label: str = "fault_label",
    hidden: Sequence[int] = (128, 64),
    epochs: int = 10,
    batch: int = 2048,
    seed: int = 42,
    name: str = "feedforward_network",
) -> FaultModel:
    """Feed-forward network on scaled features."""
    counts = class_counts(train, label)
    fallback = constant_model(name, features, counts)
    if fallback is not None:
        return fallback
    preparation = fit_preparation(train, features, scale=True)
    frame = _training_frame(train, preparation, label, counts)
    estimator = MultilayerPerceptronClassifier(
        featuresCol=VECTOR,
        labelCol=label,
        layers=[len(preparation.features), *hidden, 2],
        maxIter=epochs,
        blockSize=batch,
        seed=seed,
    )
    model = _without_summary(train.sparkSession, estimator.fit(frame))
    return FaultModel(name, preparation, model, parameters={"epochs": epochs, "batch_size": batch})


# Candidates of the forest search, in order of preference.
FOREST_CANDIDATES = (
    {"trees": 80, "depth": 16, "leaf": 1},
    {"trees": 80, "depth": 24, "leaf": 2},
    {"trees": 100, "depth": None, "leaf": 2},
)


@dataclass(frozen=True)
class SearchResult:
    best: FaultModel
    trials: list[dict]


def search_forest(
    train: DataFrame,
    validation: DataFrame,
    features: Sequence[str],
    label: str = "fault_label",
    candidates: Sequence[Mapping[str, object]] = FOREST_CANDIDATES,
    seed: int = 42,
    parallelism: int = 3,
) -> SearchResult:
    """Fit every candidate, rank by average precision on the validation rows; the first wins ties.

    Both data sets need both classes (see ``class_gate``).  The preparation is
    fitted once and candidates are fitted side by side.
    """
    counts = class_counts(train, label)
    if sum(1 for n in counts.values() if n) < 2:
        raise ContractError("the search needs both classes in the training data")
    rows = sum(counts.values())
    preparation = fit_preparation(train, features)
    blocks, cuts = _binned(train, preparation, label, counts, seed)
    weights = balanced_weights(counts)

    def fit(candidate: Mapping[str, object]) -> FaultModel:
        return _fit_forest(
            blocks,
            cuts,
            rows,
            preparation,
            weights,
            candidate["trees"],
            candidate["depth"],
            candidate["leaf"],
            seed,
            TUNED_FOREST,
        )

    with ThreadPoolExecutor(parallelism) as pool:
        jobs = [pool.submit(inheritable_thread_target(train.sparkSession)(fit), c) for c in candidates]
        fits = [job.result() for job in jobs]
    drop_written(blocks)
    # One after the other: scoring loads trees into the driver.
    results = []
    for candidate, fitted in zip(candidates, fits):
        scores = ranking_scores(fitted.score(validation), label, PROBABILITY).first()
        results.append((fitted, {**candidate, "pr_auc": scores["pr_auc"], "roc_auc": scores["roc_auc"]}))
    best, best_score = None, -1.0
    for fitted, outcome in results:
        if outcome["pr_auc"] is not None and outcome["pr_auc"] > best_score:
            best, best_score = fitted, outcome["pr_auc"]
    if best is None:
        raise ContractError("the search needs both classes in the validation data")
    return SearchResult(best, [outcome for _, outcome in results])


def class_gate(train: DataFrame, validation: DataFrame, label: str = "fault_label") -> DataFrame:
    """One row: may the search run, or which data set lacks a class.

    Both class distributions are reported.
    """
    names = ("training", "validation")
    labels = [
        frame.select(ref(label).alias("y"), F.lit(name).alias("part"))
        for name, frame in zip(names, (train, validation))
    ]
    both = labels[0].unionByName(labels[1]).agg(
        *[
            F.count_if((F.col("part") == name) & (F.col("y") == group)).alias(f"{name}_{kind}_rows")
            for name in names
            for group, kind in ((0, "normal"), (1, "fault"))
        ]
    )

    def lacks(name: str) -> Column:
        return (F.col(f"{name}_normal_rows") == 0) | (F.col(f"{name}_fault_rows") == 0)

    reason = F.when(lacks("training"), "training data lacks a class").when(
        lacks("validation"), "validation data lacks a class"
    )
    return both.withColumns(
        {"status": F.when(reason.isNull(), READY).otherwise(SKIPPED), "reason": reason}
    )


def score_with_contract(df: DataFrame, model: FaultModel, threshold: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """``(scored, rejected)``: rows with missing or non-finite features are kept apart."""
    judged = with_validity(require_columns(df, model.features), model.features)
    rejected = judged.filter(~F.col("valid")).drop("valid")
    scored = model.score(judged.filter("valid").drop("valid"), threshold)
    return scored.withColumn("model_name", F.lit(model.name)), rejected


def select_deployable(metrics: DataFrame) -> DataFrame:
    """The model to deploy: tuned before base, never a constant fallback.

    ``metrics`` has ``model, status, is_tuned``.
    """
    usable = metrics.filter(F.col("status") == COMPLETED)
    return usable.orderBy(F.col("is_tuned").desc(), "model").limit(1)
