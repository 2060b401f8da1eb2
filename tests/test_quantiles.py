from __future__ import annotations

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import quantiles
from gaugeworks.operators.quantiles import exact_medians, exact_quantiles, prefix_counts, value_of, with_order_key

SHAPES = {
    "uniform": lambda rng: rng.uniform(-5, 5),
    "mostly_zero": lambda rng: 0.0 if rng.random() < 0.4 else rng.uniform(0, 1),
    "heavy_tail": lambda rng: rng.paretovariate(0.5),
    "few_values": lambda rng: float(rng.randrange(3)),
    "constant": lambda rng: 7.25,
    "close": lambda rng: 1e9 + rng.randrange(4000) * 2.0**-20,
    "both_signs": lambda rng: math.copysign(10.0 ** rng.uniform(-320, 300), rng.random() - 0.5),
}
NAMES = (*SHAPES, "sparse")
PROBABILITIES = [0.0, 0.25, 0.5, 0.7, 0.95, 1.0]


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(3)
    rows = [tuple(make(rng) for make in SHAPES.values()) + (None if i % 3 else float(i),) for i in range(9001)]
    schema = ", ".join(f"{name} double" for name in NAMES)
    return spark.createDataFrame(rows, schema).cache(), rows


def values_of(rows, name):
    return np.array([row[NAMES.index(name)] for row in rows if row[NAMES.index(name)] is not None])


@pytest.mark.parametrize("leaf_rows", [0, 10, 8_192, 10**6])
def test_linear_quantiles(frame, leaf_rows):
    df, rows = frame
    found = exact_quantiles(df, {name: PROBABILITIES for name in NAMES}, leaf_rows=leaf_rows)
    for name in NAMES:
        assert np.allclose(found[name], np.quantile(values_of(rows, name), PROBABILITIES), rtol=1e-12, atol=0), name


@pytest.mark.parametrize("leaf_rows", [0, 8_192])
def test_discrete_quantiles(frame, leaf_rows):
    df, rows = frame
    found = exact_quantiles(df, {name: PROBABILITIES for name in NAMES}, discrete=True, leaf_rows=leaf_rows)
    for name in NAMES:
        ordered = np.sort(values_of(rows, name))
        expected = [ordered[max(0, math.ceil(p * len(ordered)) - 1)] for p in PROBABILITIES]
        assert found[name] == expected, name


def test_keys_are_the_bits(spark):
    """All exponents, next to powers of two, subnormal numbers, zeros, infinities."""
    values = [0.0, -0.0, math.inf, -math.inf, math.nan, 5e-324, -5e-324, 2.0**-1022, 1.7976931348623157e308]
    for exponent in range(-1074, 1024):
        power = 2.0**exponent
        values += [power, -power, math.nextafter(power, 0.0), math.nextafter(power, math.inf), power * 1.37]
    rng = np.random.default_rng(2)
    values += [x for x in np.frombuffer(rng.bytes(8 * 20_000), "<f8").tolist() if not math.isnan(x)]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    for row in with_order_key(df, "x", "key").collect():
        x, key = row["x"], row["key"]
        expected = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
        assert key == (-expected if x < 0 else expected), x
        assert math.isnan(x) or value_of(key) == x


def test_infinities_and_nan_have_their_places(spark):
    values = [math.inf, -math.inf, math.nan, 1.0, 2.0, -3.0, None, 0.0, -0.0]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    for leaf_rows in (0, 100):
        found = exact_quantiles(df, {"x": [k / 8 for k in range(1, 9)]}, discrete=True, leaf_rows=leaf_rows)["x"]
        assert found[:7] == [-math.inf, -3.0, 0.0, 0.0, 1.0, 2.0, math.inf] and math.isnan(found[7])


def test_integers_and_decimals(spark):
    df = spark.createDataFrame([(i, i) for i in range(101)], "a long, b int").withColumn("c", F.col("a").cast("decimal(12,2)") / 4)
    assert exact_quantiles(df, {"a": [0.5], "b": [0.0, 1.0], "c": [0.5]}, leaf_rows=3) == {"a": [50.0], "b": [0.0, 100.0], "c": [12.5]}


def test_no_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    assert exact_medians(df, ["a", "b"]) == {"a": None, "b": 1.5}
    assert exact_medians(df, ["a", "b"], leaf_rows=0) == {"a": None, "b": 1.5}
    assert exact_medians(df.filter(F.lit(False)), ["b"]) == {"b": None}
    assert exact_quantiles(df, {}) == {}


def test_column_named_with_backtick(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "x double").withColumnRenamed("x", "a`b.c")
    assert exact_medians(df, ["a`b.c"]) == {"a`b.c": 1.5}


def test_passes_count_before_they_shuffle(spark, frame):
    """No sketch, no list of values; every pass is a scan, a partial count and an exchange of counts."""
    df, _ = frame
    brackets = [quantiles._Bracket("uniform", None, 64), quantiles._Bracket("close", 1052, 52, 0, 9001)]
    plan = prefix_counts(df, brackets)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "partial_count" in plan and plan.count("Exchange") == 1
    assert not any(word in plan for word in ("percentile", "collect", "SortMergeJoin", "Window"))


def test_few_counts_reach_the_driver(frame, monkeypatch):
    df, _ = frame
    seen = []
    counts = quantiles._counts

    def counted(*args):
        found = counts(*args)
        seen.append(max(map(len, found.values()), default=0))
        return found

    monkeypatch.setattr(quantiles, "_counts", counted)
    exact_quantiles(df, {name: [0.1, 0.5] for name in NAMES}, leaf_rows=100)
    assert len(seen) <= len(quantiles.SHIFTS) and max(seen) <= 8_192
