from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import splits
from gaugeworks.operators.contracts import ContractError


def classes(spark, normal, fault):
    return (
        spark.range(normal + fault)
        .withColumn("label", (F.col("id") >= normal).cast("int"))
        .withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")))
    )


def sizes(df, *keys):
    return {tuple(row[k] for k in keys): row["count"] for row in df.groupBy(*keys).count().collect()}


def test_recorded_sizes():
    assert splits.split_sizes(225) == (157, 191)
    assert splits.split_sizes(10) == (7, 8)
    assert splits.split_sizes(3) == (1, 2)
    with pytest.raises(ContractError):
        splits.split_sizes(2)


@pytest.mark.parametrize("normal,fault,expected", [(225, 10, {"train": (157, 7), "validation": (34, 1), "test": (34, 2)}), (3, 3, {"train": (1, 1), "validation": (1, 1), "test": (1, 1)})])
def test_stratified_split_has_exact_sizes(spark, normal, fault, expected):
    split = splits.stratified_split(classes(spark, normal, fault), "label", ["id"])
    got = sizes(split, "split", "label")
    for part, (n, f) in expected.items():
        assert got[part, 0] == n and got[part, 1] == f


def test_split_does_not_depend_on_the_layout(spark):
    df = classes(spark, 300, 40)
    a = splits.stratified_split(df, "label", ["id"]).select("id", "split")
    b = splits.stratified_split(df.repartition(7, "ts"), "label", ["id"]).select("id", "split")
    assert a.exceptAll(b).isEmpty()
    other = splits.stratified_split(df, "label", ["id"], seed=7).select("id", "split")
    assert not a.exceptAll(other).isEmpty()


def test_small_class_is_refused(spark):
    with pytest.raises(ContractError):
        splits.stratified_split(classes(spark, 20, 2), "label", ["id"])


def test_cutoffs_are_the_digests_at_their_ranks(spark):
    df = splits.with_digest(classes(spark, 500, 60), ["id"], 42)
    found = splits.rank_cutoffs(df, "label", splits.DIGEST, {0: [1, 250, 500], 1: [60]})
    normal = sorted(hashlib.md5(f"42:{i}".encode()).hexdigest() for i in range(500))
    fault = sorted(hashlib.md5(f"42:{i}".encode()).hexdigest() for i in range(500, 560))
    assert found == {(0, 1): normal[0], (0, 250): normal[249], (0, 500): normal[499], (1, 60): fault[59]}


@pytest.mark.parametrize("leaf_rows", [0, 1, 10, 10**6])
def test_no_leaf_has_more_rows(spark, monkeypatch, leaf_rows):
    df = splits.with_digest(classes(spark, 9_000, 60), ["id"], 42)
    ordered = sorted(hashlib.md5(f"42:{i}".encode()).hexdigest() for i in range(9_000))
    put_in_order = splits._leaf_digests

    def watched(frame, label, digest, leaves):
        for (group, _), (prefix, _) in leaves.items():
            assert frame.filter((F.col(label) == group) & F.col(digest).startswith(prefix)).count() <= leaf_rows
        return put_in_order(frame, label, digest, leaves)

    monkeypatch.setattr(splits, "_leaf_digests", watched)
    monkeypatch.setattr(splits, "PREFIX_DIGITS", 2 if leaf_rows else 8)
    found = splits.rank_cutoffs(df, "label", splits.DIGEST, {0: [1, 4_500, 9_000]}, leaf_rows)
    assert found == {(0, 1): ordered[0], (0, 4_500): ordered[4_499], (0, 9_000): ordered[8_999]}


def test_rows_of_one_key_share_a_cutoff(spark):
    """A third of the rows have one key: their digest is the cutoff, whatever the leaf."""
    df = spark.range(300).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"), F.lit(0).alias("label"))
    keyed = splits.with_digest(df, ["id"], 42)
    ordered = sorted(row[splits.DIGEST] for row in keyed.collect())
    for leaf_rows in (5, 1000):
        found = splits.rank_cutoffs(keyed, "label", splits.DIGEST, {0: [1, 100, 150, 299]}, leaf_rows)
        assert found == {(0, rank): ordered[rank - 1] for rank in (1, 100, 150, 299)}
    with pytest.raises(ContractError):
        splits.rank_cutoffs(keyed, "label", splits.DIGEST, {0: [301]})


def test_partition_check(spark):
    split = splits.stratified_split(classes(spark, 100, 20), "label", ["id"])
    row = splits.partition_check(split, ["id"]).first()
    assert row["adds_up"] and row["none_empty"] and row["shared_keys"] == 0
    rejected = split.unionByName(split.limit(1).withColumn("id", F.lit(-5).cast("long")).withColumn("split", F.lit("rejected")))
    row = splits.partition_check(rejected, ["id"]).first()
    assert row["adds_up"] and row["rejected_rows"] == 1
    doubled = split.unionByName(split.withColumn("split", F.lit("test")))
    assert splits.partition_check(doubled, ["id"]).first()["shared_keys"] > 0


@pytest.mark.parametrize("exact", [True, False])
def test_chronological_split(spark, exact):
    split = splits.chronological_split(classes(spark, 100, 0), "ts", exact=exact)
    assert sizes(split, "split") == {("train",): 70, ("validation",): 15, ("test",): 15}
    assert {row["status"] for row in splits.leakage_check(split, "ts").collect()} == {"PASS"}


def test_chronological_split_needs_distinct_boundaries(spark):
    same = classes(spark, 10, 0).withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    with pytest.raises(ContractError):
        splits.chronological_split(same, "ts")
    with pytest.raises(ContractError):
        splits.chronological_split(same.limit(0), "ts")


def test_audit_warns_about_a_missing_class(spark):
    split = splits.chronological_split(classes(spark, 90, 10), "ts")
    status = {r["split"]: r["status"] for r in splits.split_audit(split, "label", "ts").collect()}
    assert status == {"train": "warning", "validation": "warning", "test": "passed"}


def test_capped_quotas():
    assert splits.capped_quotas({0: 50, 1: 5}, 100) == {0: 50, 1: 5}
    assert splits.capped_quotas({0: 500, 1: 90}, 90) == {0: 60, 1: 30}
    assert splits.capped_quotas({0: 500, 1: 3}, 90) == {0: 87, 1: 3}
    assert splits.capped_quotas({0: 10, 1: 500}, 90) == {0: 10, 1: 30}
    assert splits.capped_quotas({1: 500}, 90) == {0: 0, 1: 90}
    assert splits.capped_quotas({1: 500}, 90, fill_single_class=False) == {0: 0, 1: 30}


def test_fault_preserving_quotas():
    assert splits.fault_preserving_quotas({0: 500, 1: 30}, 100) == {0: 70, 1: 30}
    assert splits.fault_preserving_quotas({0: 500, 1: 300}, 100) == {0: 0, 1: 100}
    assert splits.fault_preserving_quotas({0: 20, 1: 3}, 100) == {0: 20, 1: 3}
    with pytest.raises(ContractError):
        splits.fault_preserving_quotas({0: 5}, 100)


@pytest.mark.parametrize("cap", [1, 2, 30, 90, 400])
def test_samples_have_exact_sizes(spark, cap):
    df = classes(spark, 300, 40)
    sample = splits.capped_class_sample(df, "label", ["id"], cap)
    quotas = splits.capped_quotas({0: 300, 1: 40}, cap)
    assert sizes(sample, "label") == {(k,): n for k, n in quotas.items() if n}
    kept = splits.fault_preserving_sample(df, "label", ["id"], cap)
    assert kept.filter("label = 1").count() == min(40, cap)
    assert kept.count() == min(340, cap)


def test_samples_only_compare_digests(spark):
    sample = splits.capped_class_sample(classes(spark, 300, 40), "label", ["id"], 50)
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
