from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gaugeworks.functions import columns as C
from gaugeworks.operators import contracts, profiling, quality, sequence
from gaugeworks.operators.contracts import ContractError
from gaugeworks.roles import SeriesRoles


def rows_of(df, *keys):
    return {tuple(row[k] for k in keys): row for row in df.collect()}


def test_index_aliases(spark):
    assert quality.find_index_column(["a", "Unnamed: 0"]) == "Unnamed: 0"
    assert quality.find_index_column(["Unnamed: 0", "_c0"]) == "_c0"
    assert quality.find_index_column(["Unnamed: 0", "_c0"], ("Unnamed: 0", "_c0")) == "Unnamed: 0"
    assert quality.find_index_column(["a"]) is None
    df = spark.createDataFrame([(1,)], "a int")
    assert quality.normalize_index(df).columns == ["a"]


def test_null_counts_with_odd_names(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b int").toDF("x y", "a.b`c")
    found = rows_of(quality.null_counts(df), "column_name")
    assert found["x y",]["null_count"] == 0 and found["a.b`c",]["null_count"] == 2
    assert rows_of(quality.null_metrics(df), "metric_name")["null_count_a.b`c",]["status"] == "WARNING"


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, ts timestamp, v double")
    assert quality.duplicate_summary(df, ["ts"]).first().asDict() == {"duplicated_keys": 0, "excess_rows": 0}
    assert quality.deduplication_account(df).first()["rows_removed"] == 0
    report = rows_of(quality.quality_report(df, "ts", "id", "r"), "metric_name")
    assert report["total_rows",]["metric_value"] == 0 and len(report) == 7
    assert quality.time_statistics(df, "ts").first()["min_timestamp"] is None


def test_null_times_are_duplicates_of_each_other(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (1,), (1,), (2,)], "k int")
    assert quality.duplicate_summary(df, ["k"]).first().asDict() == {"duplicated_keys": 2, "excess_rows": 3}
    assert [r["k"] for r in quality.duplicate_groups(df, ["k"], 1).collect()] == [None]


def test_sequence_sums_are_exact(spark):
    big = 1 << 62
    df = spark.range(big, big + 5)
    assert quality.arithmetic_sequence_check(df, "id").first()["is_sequence"]
    holed = df.filter(F.col("id") != big + 1)
    assert not quality.arithmetic_sequence_check(holed, "id").first()["is_sequence"]


def test_one_reading_has_no_deviation_and_no_gap(spark):
    roles = SeriesRoles(time="ts", seq=("id",), analog=("v",))
    df = spark.createDataFrame([(1, 5.0)], "id long, v double").withColumn("ts", F.current_timestamp())
    assert quality.sensor_statistics(df, ["v"]).first()["stddev"] is None
    assert sequence.with_time_gap(df, roles).first()[sequence.GAP] is None
    gaps = quality.gap_summary(sequence.with_time_gap(df, roles), sequence.GAP)
    assert gaps.first().asDict() == {"min_gap_seconds": None, "max_gap_seconds": None, "avg_gap_seconds": None, "unexpected_gaps": 0}


def test_quarantine_keeps_every_row(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0), (None, None)], "a int, v double")
    rules = {"no_a": F.col("a").isNull(), "small": F.col("v") < 5}
    accepted, rejected = quality.quarantine(df, rules)
    assert [r["a"] for r in accepted.collect()] == [1]
    assert sorted((str(r["a"]), r["reject_reasons"]) for r in rejected.collect()) == [("2", ["small"]), ("None", ["no_a"])]


def test_state_distribution_counts_nulls(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (0, None)], "a int, b int")
    found = {(r["flag"], r["value"]): r["row_count"] for r in quality.state_distribution(df, ["a", "b"]).collect()}
    assert found == {("a", "1"): 2, ("a", "0"): 1, ("b", "0"): 1, ("b", None): 2}


def test_finite_values(spark):
    values = [1.5, None, float("nan"), float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(C.finite_or_null(F.col("v"))).collect()] == [1.5, None, None, None, None]
    assert [r[0] for r in df.select(C.is_finite(F.col("v"))).collect()] == [True, False, False, False, False]


def test_labels(spark):
    df = spark.createDataFrame([("1",), ("0.0",), (None,), ("x",), ("NaN",), ("Infinity",)], "y string")
    assert [r["y"] for r in contracts.clean_labels(df, "y").collect()] == [1, 0]
    with pytest.raises(ContractError):
        contracts.clean_labels(df.unionByName(spark.createDataFrame([("2",)], "y string")), "y")


def test_contracts(spark):
    df = spark.createDataFrame([(1, 2.0)], "a int, v double").withColumn("timestamp", F.current_timestamp())
    assert contracts.check_source(df) is df
    with pytest.raises(ContractError):
        contracts.check_source(df.drop("timestamp"))
    with pytest.raises(ContractError):
        contracts.check_source(df.withColumn("machine_id", F.lit("m")))
    with pytest.raises(ContractError):
        contracts.check_source(df.limit(0))
    with pytest.raises(ContractError):
        contracts.check_header(["a", "timestamp", "a"])
    with pytest.raises(ContractError):
        contracts.require_columns(df, ["a", "label"])
    with pytest.raises(ContractError):
        contracts.require_times(df.withColumn("timestamp", F.lit(None).cast("timestamp")), "timestamp")
    with pytest.raises(ContractError):
        contracts.scoring_contract(df.select("a", "v"), ["v"])
    with pytest.raises(ContractError):
        contracts.check_model(3, ["a", "b"], 2)
    assert contracts.scoring_contract(df.select("a", "v"), ["v"], ["a"]).columns == ["a", "v", "valid"]


def test_feature_columns_leave_out_labels_and_index(spark):
    df = spark.createDataFrame([(1, 2, 3.0, "x", 1)], "_c0 int, `Unnamed: 0` int, v double, failure_id string, fault_label int")
    assert contracts.feature_columns(df, df) == ["v"]
    assert contracts.feature_columns(df, df.drop("v")) == []


def test_identifiers():
    assert C.check_identifier("a_1") == "a_1"
    for bad in ("1a", "a-b", "", "a.b", "a;drop"):
        with pytest.raises(ValueError):
            C.check_identifier(bad)


def test_profiles_of_odd_columns(spark):
    df = spark.createDataFrame([(1, 1.0, None, 2.0), (0, 1.0, None, None), (1, 1.0, None, 2.0)], "y int, same double, none double, half double")
    names = ["same", "none", "half"]
    constant = rows_of(profiling.constant_features(df, names), "feature")
    assert [constant[n,]["is_constant"] for n in names] == [True, True, False]
    correlations = profiling.label_correlations(df, names, "y").collect()
    assert [r["correlation"] for r in correlations] == [None, None, None]
    zeroed = rows_of(profiling.label_correlations(df, ["half"], "y", null_as_zero=True), "feature")
    assert zeroed["half",]["correlation"] == pytest.approx(1.0)


def test_recorded_hour(spark):
    sine, cosine = C.cyclic_hour(F.lit(2))
    row = spark.range(1).select(sine.alias("s"), cosine.alias("c")).first()
    assert row["s"] == pytest.approx(0.49999999999999994, abs=1e-15)
    assert row["c"] == pytest.approx(0.8660254037844387, abs=1e-15)
