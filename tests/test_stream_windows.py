"""Rolling columns on a stream against the batch operator over the same readings."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import sequence
from gaugeworks.roles import SeriesRoles
from gaugeworks.streaming import windows

ROLES = SeriesRoles(time="at", seq=("seq",), machine=("machine",), analog=("v",))
SCHEMA = "machine string, seq long, at timestamp, v double"
LOOKBACK = sequence.ROLLING_ROWS - 1


def build(window):
    return {**sequence.rolling_expressions(window, ROLES.analog), **sequence.delta_expressions(window, ROLES.analog)}


def readings(spark, rows):
    frame = spark.createDataFrame(rows, "machine string, seq long, second long, v double")
    return frame.withColumn("at", F.timestamp_seconds("second")).select("machine", "seq", "at", "v")


def some(first, count, seed=0):
    """One machine holds most rows, one is null, times tie."""
    draw = random.Random(seed + first)
    machines = ["hot"] * 6 + ["b", None]
    return [(draw.choice(machines), k, 10 * (k // 3), draw.random() if k % 11 else None) for k in range(first, first + count)]


def run(spark, tmp_path, **options):
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    windows.run_windows(stream, ROLES, build, LOOKBACK, str(tmp_path / "out"), str(tmp_path / "state"), **options)


def arrive(spark, tmp_path, rows):
    readings(spark, rows).write.mode("append").parquet(str(tmp_path / "in"))


def of_route(spark, tmp_path, route):
    return spark.read.parquet(str(tmp_path / "out")).filter(F.col("route") == route).drop("route", "batch")


def expected(spark, rows):
    return sequence.with_window_columns(readings(spark, rows), ROLES, build, LOOKBACK)


def same(found, wanted):
    names = sorted(wanted.columns)
    key = lambda row: (row["seq"], str(row))
    return sorted(found.select(names).collect(), key=key) == sorted(wanted.select(names).collect(), key=key)


def test_batches_and_restarts_equal_the_batch_operator(spark, tmp_path):
    rows = some(0, 400)
    for begin in (0, 90, 180, 300):
        arrive(spark, tmp_path, rows[begin : {0: 90, 90: 180, 180: 300, 300: 400}[begin]])
        run(spark, tmp_path, rows_per_range=60)
    assert same(of_route(spark, tmp_path, "accepted"), expected(spark, rows))
    assert of_route(spark, tmp_path, "late").count() == 0


def test_readings_out_of_order_wait_and_late_ones_are_routed(spark, tmp_path):
    rows = some(0, 300)
    mixed = sorted(rows, key=lambda row: (row[2] + random.Random(row[1]).randint(0, 100), row[1]))
    for begin in range(0, 300, 100):
        arrive(spark, tmp_path, mixed[begin : begin + 100])
        run(spark, tmp_path, delay_seconds=110)
    held = windows.waiting(spark, str(tmp_path / "out"), readings(spark, []).schema, 2)
    done = of_route(spark, tmp_path, "accepted")
    assert 0 < held.count() and held.count() + done.count() == 300 and of_route(spark, tmp_path, "late").count() == 0
    # An answered reading once more, one without a time, and one that lets the rest go.
    arrive(spark, tmp_path, [rows[0], ("b", 900, None, 1.0), ("c", 901, 10_000, 1.0), ("c", 902, 20_000, 1.0)])
    run(spark, tmp_path, delay_seconds=110)
    assert same(of_route(spark, tmp_path, "accepted"), expected(spark, [*rows, ("c", 901, 10_000, 1.0)]))
    assert [r.seq for r in of_route(spark, tmp_path, "late").collect()] == [rows[0][1]]
    assert [r.seq for r in of_route(spark, tmp_path, "rejected").collect()] == [900]


def test_a_replayed_batch_replaces_itself(spark, tmp_path, monkeypatch):
    rows = some(0, 200)
    arrive(spark, tmp_path, rows[:100])
    run(spark, tmp_path)
    arrive(spark, tmp_path, rows[100:])

    def lost(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patch:
        patch.setattr(windows, "_delete", lost)
        with pytest.raises(Exception):
            run(spark, tmp_path)
    run(spark, tmp_path)
    assert same(of_route(spark, tmp_path, "accepted"), expected(spark, rows))


def test_a_tie_break_is_required(spark, tmp_path):
    with pytest.raises(ValueError):
        windows.run_windows(None, ROLES.with_(seq=()), build, LOOKBACK, "out", "state")
