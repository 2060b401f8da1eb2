from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gaugeworks.operators import forests, training

WEIGHTS = (2 / 3, 2.0)


@pytest.fixture(scope="module")
def rows(spark):
    base = spark.range(0, 900, 1, 3).select("id", (F.col("id") % 4 == 0).cast("int").alias("label"))
    noise = F.sin(F.col("id") * 12.9898) * 2
    return base.withColumns(
        {"a": F.col("label") * 1.5 + noise, "b": F.cos(F.col("id") * 3.7) + F.col("label"), "c": F.lit(4.0), "d": F.col("id") % 5}
    ).cache()


FEATURES = ["a", "b", "c", "d"]


def scored(spark, rows, grown, trees, cuts, plan, path):
    forests.save_forest(spark, grown, trees, cuts, plan, {"impurity": "gini", "featuresCol": training.VECTOR}, path)
    model = RandomForestClassificationModel.load(path)
    assert model.getNumTrees == len(trees)
    found = model.transform(training.assemble(rows, FEATURES))
    return {r["id"]: (r["prediction"], r["p"]) for r in found.select("id", "prediction", vector_to_array("probability")[1].alias("p")).collect()}


@pytest.mark.parametrize("depth, leaf", [(4, 1), (20, 2), (20, 10)])
def test_a_tree_of_all_rows_is_that_of_pyspark(spark, rows, tmp_path, monkeypatch, depth, leaf):
    monkeypatch.setattr(forests, "_times", lambda plan, tree, block, count: np.ones(count, np.uint8))
    plan = forests.ForestPlan(len(FEATURES), 1, depth, leaf, WEIGHTS, 42)
    cuts = forests.feature_cuts(rows, FEATURES, "label", WEIGHTS, 900, 1)
    held = rows.toPandas()
    bins = np.array([np.searchsorted(c, held[n]) for c, n in zip(cuts, FEATURES)], dtype=np.uint8)
    nodes = forests.grow(bins, held["label"].to_numpy().astype(np.uint8), np.ones(900, np.uint8), depth, plan, np.random.default_rng(0))
    weighted = rows.withColumn("w", F.when(F.col("label") == 1, WEIGHTS[1]).otherwise(WEIGHTS[0]))
    tree = DecisionTreeClassifier(labelCol="label", weightCol="w", maxDepth=depth, minInstancesPerNode=leaf).fit(training.assemble(weighted, FEATURES))
    # Splits of equal gain may be taken in another order, so a deep tree may end a few nodes apart.
    assert abs(len(nodes["id"]) - tree.numNodes) <= 0.05 * tree.numNodes
    child = nodes["feature"] >= 0
    assert (nodes["left_id"][child] > nodes["id"][child]).all() and (nodes["n0"] + nodes["n1"] >= leaf).all()
    crown = forests.Crown(
        nodes["feature"].tolist(), nodes["bin"].tolist(), nodes["gain"].tolist(), nodes["left_id"].tolist(), nodes["right_id"].tolist(),
        [(int(x), int(y)) for x, y in zip(nodes["n0"], nodes["n1"])],
    )
    mine = scored(spark, rows, forests.GrownTrees({0: crown}, None, {}), [0], cuts, plan, str(tmp_path / "tree"))
    found = tree.transform(training.assemble(rows, FEATURES)).select("id", "prediction").collect()
    assert sum(mine[r["id"]][0] == r["prediction"] for r in found) >= 0.99 * 900


def test_nodes_split_by_all_tasks_are_those_of_one_task(spark, rows, tmp_path):
    cuts = forests.feature_cuts(rows, FEATURES, "label", WEIGHTS, 900, 1)
    blocks = forests.binned_blocks(rows, FEATURES, "label", cuts)
    assert blocks.count() == 3 and blocks.agg(F.sum("row_count")).first()[0] == 900
    found = []
    for limit in (10_000, 80):
        plan = forests.ForestPlan(len(FEATURES), 1, 12, 2, WEIGHTS, 42, limit)
        grown = forests.grow_trees(blocks, 900, [0, 1], plan)
        assert (len(grown.crowns[0].feature) > 1) == (limit == 80)
        found.append([scored(spark, rows, grown, [tree], cuts, plan, str(tmp_path / f"{limit}_{tree}")) for tree in (0, 1)])
    for whole, split in zip(*found):
        assert {key: value[0] for key, value in whole.items()} == {key: value[0] for key, value in split.items()}
    assert found[0][0] != found[0][1]


def test_crowns_end_at_their_depth_and_in_pure_nodes(spark, rows, tmp_path):
    cuts = forests.feature_cuts(rows, FEATURES, "label", WEIGHTS, 900, 1)
    blocks = forests.binned_blocks(rows, FEATURES, "label", cuts)
    plan = forests.ForestPlan(len(FEATURES), 6, 3, 2, WEIGHTS, 42, 10)
    grown = forests.grow_trees(blocks, 900, range(6), plan)
    assert max(max(crown.level) for crown in grown.crowns.values()) == 3
    scored(spark, rows, grown, [1, 4], cuts, plan, str(tmp_path / "deep"))
    assert RandomForestClassificationModel.load(str(tmp_path / "deep")).trees[0].depth <= 3
    same = rows.withColumns({n: F.lit(1.0) for n in FEATURES})
    flat = forests.grow_trees(forests.binned_blocks(same, FEATURES, "label", [np.empty(0)] * 4), 900, [0], plan)
    assert flat.crowns[0].feature == [-1] and flat.size(0) == 1


def test_other_classes_are_refused(spark, rows):
    strange = rows.withColumn("label", F.when(F.col("id") == 7, 2).otherwise(F.col("label")))
    with pytest.raises(Exception, match="classes 0 and 1"):
        forests.binned_blocks(strange, FEATURES, "label", [np.empty(0)] * 4)


def test_jobs_do_not_grow_with_the_depth(spark):
    noise = spark.range(3000).select(
        (F.xxhash64("id", F.lit(0)) % 3 == 0).cast("int").alias("fault_label"),
        *[(F.xxhash64("id", F.lit(i)) % 1000).cast("double").alias(f"x{i}") for i in range(1, 5)],
    ).cache()
    jobs = []
    for depth in (3, 20):
        spark.sparkContext.setJobGroup(f"depth {depth}", "forest")
        fitted = training.train_forest(noise, ["x1", "x2", "x3", "x4"], trees=6, depth=depth)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"depth {depth}")))
        assert max(tree.depth for tree in fitted.model.trees) > min(depth, 9) - 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # It was a job for every level of a part of the forest.
    assert jobs[1] <= jobs[0] + 2
