from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import labeling
from gaugeworks.operators.labeling import COMPRESSOR_FAILURES, FaultWindow
from gaugeworks.roles import SeriesRoles

ROLES = SeriesRoles(time="ts", seq=("id",))


def readings(spark, *times):
    rows = [(i, t) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "id long, t string").select("id", F.col("t").cast("timestamp").alias("ts"))


def ids(df):
    return [row["failure_id"] for row in df.orderBy("id").collect()]


def test_windows_are_closed_at_whole_seconds(spark):
    df = readings(spark, "2020-04-17 23:59:59", "2020-04-18 00:00:00", "2020-04-18 23:59:59", "2020-04-18 23:59:59.5", None)
    found = labeling.label_by_windows(df, ROLES, COMPRESSOR_FAILURES)
    assert ids(found) == ["NO_FAILURE", "F1", "F1", "NO_FAILURE", "NO_FAILURE"]
    assert [r["fault_label"] for r in found.orderBy("id").collect()] == [0, 1, 1, 0, 0]


def test_the_last_window_wins(spark):
    windows = [
        FaultWindow("A", "2024-01-01 00:00:00", "2024-01-01 10:00:00"),
        FaultWindow("B", "2024-01-01 05:00:00", "2024-01-01 06:00:00"),
    ]
    df = readings(spark, "2024-01-01 04:59:59", "2024-01-01 05:00:00", "2024-01-01 06:00:00", "2024-01-01 06:00:01")
    assert ids(labeling.label_by_windows(df, ROLES, windows)) == ["A", "B", "B", "A"]
    assert ids(labeling.label_by_windows(df, ROLES, windows[::-1])) == ["A", "A", "A", "A"]


@pytest.mark.parametrize("count", [3, 64, 65, 90])
def test_any_number_of_literal_windows(spark, count):
    """Overlapping windows, on both sides of the number from which they become a table."""
    windows = [FaultWindow(f"{i:02}", f"2024-01-01 00:{i // 2:02}:00", f"2024-01-01 00:{i // 2 + 1:02}:30") for i in range(count)]
    times = [f"2024-01-01 00:{m:02}:{s:02}" for m in range(0, 50) for s in (0, 29, 31)]
    expected = []
    for time in times:
        holding = [w.failure_id for w in windows if w.start <= time <= w.end]
        expected.append(holding[-1] if holding else labeling.NO_FAILURE)
    found = labeling.label_by_windows(readings(spark, *times), ROLES, windows)
    assert ids(found) == expected


@pytest.mark.parametrize("options", [{}, {"most_broadcast": 0}, {"most_broadcast": 0, "rows_per_range": 50}, {"rows_per_range": 20}])
@pytest.mark.parametrize("per_machine", [False, True])
def test_window_table_equals_brute_force(spark, options, per_machine):
    rng = random.Random(11)
    start = datetime(2024, 1, 1)
    windows = []
    for i in range(60):
        begin = start + timedelta(seconds=rng.randrange(3 * 86_400))
        length = rng.choice([-5, 0, 30, 3000, 100_000])
        windows.append((i, f"W{i}", begin, begin + timedelta(seconds=length), f"m{rng.randrange(3)}"))
    rows = [
        (i, start + timedelta(seconds=rng.randrange(4 * 86_400), microseconds=rng.choice([0, 500_000])), f"m{rng.randrange(3)}")
        for i in range(800)
    ]
    rows += [(800 + i, w[3], w[4]) for i, w in enumerate(windows)] + [(900 + i, w[2], w[4]) for i, w in enumerate(windows)]
    expected = {}
    for i, ts, machine in rows:
        hits = [w for w in windows if w[2] <= ts <= w[3] and (not per_machine or w[4] == machine)]
        expected[i] = max(hits)[1] if hits else "NO_FAILURE"
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, machine string")
    table = spark.createDataFrame(windows, "ordinal int, failure_id string, start timestamp_ntz, end timestamp_ntz, machine string")
    found = labeling.label_by_table(df, table, ROLES, machine=["machine"] if per_machine else [], **options)
    assert {r["id"]: r["failure_id"] for r in found.collect()} == expected
    assert found.columns == ["id", "ts", "machine", "failure_id", "fault_label"]


def test_percentage_of_nothing_is_zero(spark):
    empty = spark.createDataFrame([], "fault_label int")
    assert labeling.fault_percentage(empty, "fault_label").first()["fault_percentage"] == 0.0
