from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeworks.llm.negatives import _Block, _block, hard_negatives, nearest_of_label, within_windows
from gaugeworks.llm.queries import op13_hard_negatives

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain_rows(rows, every=100, positives=5, negatives=5, low=80, high=100):
    """All scores of all anchors; rows of (id, vector, label)."""
    taken = {
        (i, label, tuple(int(np.floor(256.0 * float(np.float32(x)))) for x in v))
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    }
    found = set()
    for own, label, vector in taken:
        if own % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(vector, other)), i, at) for i, at, other in taken)
        best = [(-s, i) for s, i, at in scored if at == label and i != own][:positives]
        for score, positive in best:
            inside = [(-s, i) for s, i, at in scored if at != label and low * score <= -100 * s <= high * score]
            for rank, (s, i) in enumerate(inside[:negatives], 1):
                found.add((own, positive, rank, i, score, s))
    return sorted(found)


def mined(spark, rows, every=100, schema=SCHEMA, **options):
    df = spark.createDataFrame(rows, schema)
    return sorted(tuple(row[c] for c in COLUMNS) for row in hard_negatives(df, F.col("vec_id") % every == 0, **options).collect())


def made(n, dims, seed, labels=4):
    rng = np.random.default_rng(seed)
    return [(i, (rng.normal(size=dims) + 0.4).tolist(), int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("block_rows", [7, 64, 8192])
def test_like_brute_force(spark, block_rows):
    rows = made(400, 12, 1)
    assert mined(spark, rows, 20, block_rows=block_rows) == plain_rows(rows, 20)


def test_tiles_of_many_packs(spark, monkeypatch):
    monkeypatch.setattr("gaugeworks.llm.negatives.PACK_ANCHORS", 3)
    monkeypatch.setattr("gaugeworks.llm.negatives.TILE_PACKS", 2)
    rows = made(200, 9, 2)
    assert mined(spark, rows, 4, block_rows=50) == plain_rows(rows, 4)


def test_ties_and_one_hot_vector(spark):
    """A third of the rows share a vector; many scores are equal."""
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 0.5, 0.25], i % 3) if i % 3 else (i, rng.integers(0, 3, 3).astype(float).tolist(), int(rng.integers(3))) for i in range(300)]
    for block_rows in (16, 1000):
        assert mined(spark, rows, 10, block_rows=block_rows) == plain_rows(rows, 10)


def test_nulls_repeats_and_other_oddities(spark):
    rows = made(60, 5, 4, labels=2)
    rows += rows[:30] + rows[:10]
    rows += [(None, [1.0] * 5, 1), (200, None, 1), (300, [1.0, None, 1.0, 1.0, 1.0], 0), (400, [float("nan")] * 5, 0)]
    rows += [(500, [float("inf")] * 5, 1), (600, [2.0] * 5, None), (700, [], 1), (800, [3.0, 3.0], 0), (-100, [0.5] * 7, 1)]
    expected = plain_rows(rows, 10)
    assert {row[0] for row in expected} >= {10, 800, -100}
    assert mined(spark, rows, 10) == expected
    assert mined(spark, rows, 10, block_rows=8) == expected


def test_other_settings_and_clashing_columns(spark):
    rows = made(150, 6, 5)
    extra = [(*row, "x", 1, [2]) for row in rows]
    found = mined(spark, extra, 15, SCHEMA + ", id string, rank int, anchors array<int>", positives=2, negatives=3, low=50, high=90)
    assert found == plain_rows(rows, 15, 2, 3, 50, 90) and found


def test_too_large_components_raise(spark):
    with pytest.raises(Exception, match="31 bits"):
        mined(spark, [(0, [1e30], 1), (1, [1.0], 1)])


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 1)], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 1)]])
def test_empty_and_tiny_tables(spark, rows):
    assert mined(spark, rows) == plain_rows(rows) == []


def test_query_like_brute_force(spark):
    rows = [tuple(row) for row in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    moved = [(i, v, None if label is None else (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    found = sorted(tuple(row[c] for c in COLUMNS) for row in op13_hard_negatives(spark, SF).collect())
    assert found == plain_rows(moved) and found


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 40), st.integers(1, 30), st.sampled_from([1, 2, 40]), st.integers(1, 6))
def test_bounds_never_lose_a_row(seed, dims, rows, spread, n):
    rng = np.random.default_rng(seed)
    ids, labels = rng.integers(0, 2 * rows, rows), rng.integers(0, 3, rows)
    vectors = [rng.integers(-spread, spread + 1, dims) for _ in range(rows)]
    row = dict(zip(("n", "width", "dims", "ids", "labels", "columns", "least", "most"), _block(ids, labels, vectors)))
    block = _Block(row)
    anchor, label, own = rng.integers(-spread, spread + 1, dims), 1, int(ids[0])
    every = sorted({(-int(anchor @ v), int(i), int(at)) for i, at, v in zip(ids, labels, vectors)})
    scores, others = nearest_of_label(block, anchor, label, own, n)
    expected = [(s, i) for s, i, at in every if at == label and i != own][:n]
    assert list(zip((-scores).tolist(), others.tolist())) == expected
    tops = np.sort(rng.integers(-spread * dims, spread * dims + 1, 3))
    windows = np.array([(top - int(rng.integers(0, 9)), top) for top in tops.tolist()])
    for (low, top), (scores, others) in zip(windows, within_windows(block, anchor, label, windows, n)):
        expected = sorted({(s, i) for s, i, at in every if at != label and low <= -s <= top})[:n]
        assert list(zip((-scores).tolist(), others.tolist())) == expected
