"""Windows cut into ranges equal the windows Spark computes in one piece."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gaugeworks.functions.search import boundaries_not_above
from gaugeworks.operators import ranges
from gaugeworks.operators.features import with_features
from gaugeworks.operators.ranges import (
    OrderedRanges,
    _pack,
    _tail_cells,
    with_group_row_number,
    with_ordered_columns,
)
from gaugeworks.roles import SeriesRoles

WHOLE = 10**9


def series(spark, rows=3000, machines=5, seed=0, hot_machine=False, hot_instant=False, null_times=False):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    data = []
    for i in range(rows):
        machine = 0 if hot_machine and rng.random() < 0.6 else rng.randrange(machines)
        second = 500 if hot_instant and rng.random() < 0.5 else rng.randrange(10_000)
        time = None if null_times and rng.random() < 0.2 else start + timedelta(seconds=second)
        data.append((f"m{machine}", time, i, round(rng.uniform(0, 100), 2)))
    return spark.createDataFrame(data, "machine string, time timestamp_ntz, seq long, value double")


def statistics(window):
    frame = window.rowsBetween(-9, 0)
    return {
        "previous": F.lag("seq").over(window),
        "mean": F.avg("value").over(frame),
        "deviation": F.stddev("value").over(frame),
        "low": F.min("value").over(frame),
        "size": F.count("*").over(frame),
    }


@pytest.mark.parametrize("partition", [[], ["machine"]])
@pytest.mark.parametrize("shape", [{}, {"hot_machine": True}, {"hot_instant": True}, {"null_times": True}])
@pytest.mark.parametrize("rows_per_range", [40, 400])
def test_ranged_windows_equal_whole_windows(spark, partition, shape, rows_per_range):
    df = series(spark, seed=len(partition), **shape).cache()
    order = ["time", "seq"]
    plan = OrderedRanges.plan(df, [*partition, *order], rows_per_range, 9)
    assert plan.count > 3
    cut = with_ordered_columns(df, statistics, order, partition, 9, rows_per_range)
    whole = with_ordered_columns(df, statistics, order, partition, 9, WHOLE)
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))


def test_ranges_shorter_than_the_lookback_are_joined(spark):
    df = series(spark, rows=500)
    plan = OrderedRanges.plan(df, ["time", "seq"], 5, 60)
    sizes = df.groupBy(plan.range_id.alias("r")).count().collect()
    assert all(row["count"] >= 60 for row in sizes)


def test_ranges_follow_the_order_and_are_balanced(spark):
    df = series(spark, rows=20_000, hot_machine=True, hot_instant=True)
    plan = OrderedRanges.plan(df, ["machine", "time", "seq"], 500)
    found = (
        df.groupBy(plan.range_id.alias("r"))
        .agg(F.count("*").alias("n"), F.min(F.struct("machine", "time", "seq")).alias("a"), F.max(F.struct("machine", "time", "seq")).alias("b"))
        .orderBy("r")
        .collect()
    )
    assert [row["r"] for row in found] == list(range(plan.count))
    assert all(x["b"] < y["a"] for x, y in zip(found, found[1:]))
    assert max(row["n"] for row in found) < 2000


@pytest.mark.parametrize("rows_per_range", [50, 500])
def test_row_numbers(spark, rows_per_range):
    df = series(spark, hot_machine=True)
    cut = with_group_row_number(df, ["machine"], ["time", "seq"], rows_per_range=rows_per_range)
    whole = with_group_row_number(df, ["machine"], ["time", "seq"], rows_per_range=WHOLE)
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))


def test_row_numbers_with_null_group(spark):
    df = series(spark).withColumn("machine", F.when(F.col("machine") != "m1", F.col("machine")))
    cut = with_group_row_number(df, ["machine"], ["time", "seq"], rows_per_range=60)
    whole = with_group_row_number(df, ["machine"], ["time", "seq"], rows_per_range=WHOLE)
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))


def test_doubles_with_nan_and_infinity(spark):
    values = [float("nan"), float("inf"), float("-inf"), None, 0.1, -2.5] * 50
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "x double, seq long")
    cut = with_group_row_number(df, [], ["x", "seq"], rows_per_range=20)
    whole = with_group_row_number(df, [], ["x", "seq"], rows_per_range=WHOLE)
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))


def test_one_hot_instant_without_tie_break_is_still_spread(spark):
    df = series(spark, rows=2000, hot_instant=True).drop("seq")
    roles = SeriesRoles(time="time", machine=("machine",), analog=("value",))
    tied, order = ranges.with_tie_break(df, "time", ())
    plan = OrderedRanges.plan(tied, ("machine", *order), 50)
    assert tied.groupBy(plan.range_id).count().agg(F.max("count")).first()[0] < 400
    found = [
        with_features(frame, roles, rows=5, rows_per_range=per_range)
        for frame, per_range in ((df, 50), (df.repartition(5, "value"), WHOLE))
    ]
    assert found[0].columns == found[1].columns and "__tie" not in found[0].columns
    assert sorted(map(str, found[0].collect())) == sorted(map(str, found[1].collect()))


def test_empty_and_one_row(spark):
    df = series(spark, rows=1)
    assert with_ordered_columns(df, statistics, ["time", "seq"]).collect()[0]["previous"] is None
    assert with_ordered_columns(df.limit(0), statistics, ["time", "seq"]).count() == 0


def test_refuses_unordered_types(spark):
    df = spark.createDataFrame([([1],)] * 5, "x array<int>")
    with pytest.raises(TypeError):
        OrderedRanges.plan(df, ["x"], 1)


def test_bisection(spark):
    bounds = [1, 4, 4, 9]
    array = F.array(*[F.lit(b).cast("long") for b in bounds])
    df = spark.range(0, 12)
    got = [row[0] for row in df.select(boundaries_not_above(array, len(bounds), F.col("id"))).collect()]
    assert got == [sum(b <= i for b in bounds) for i in range(12)]


def test_packing():
    owner = _pack([5, 1, 5, 1, 0, 0, 5, 1], [True, False] * 4, 6)
    assert owner == [0, 0, 1, 1, 2, 2, 2, 2]
    assert _pack([5, 1, 2, 1], [True, False] * 2, 6) == [0, 0, 0, 0]
    assert _tail_cells([5, 1, 5, 3], [0, 0, 1, 1], 3) == [True, True, False, True]


def test_each_range_is_one_task_and_nothing_runs_on_one_task(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    found = with_ordered_columns(df, lambda w: {"p": F.lag("value").over(w)}, ["ts", "event_id"], [], 1, 100)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
    # Cut points are literals after optimization.
    assert "from_json" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert ranges.MAX_RANGES * 2 <= 1 << 17


def test_ranges_read_and_shuffle_once(spark, tmp_path):
    series(spark).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    found = with_ordered_columns(df, statistics, ["time", "seq"], ["machine"], lookback=9, rows_per_range=300)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1 and "Union" not in plan
    assert plan.count("Sort [") == 1
