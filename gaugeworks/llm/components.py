"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.sources.scratch import drop_written, written

MAX_ROUNDS = 60


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a``, ``b``); the root is the smallest node reachable.

    Each round links every node to the smallest of its neighbourhood, first
    from the larger neighbours, then from the smaller one (large star, small
    star; Kiveris et al., 2014), until nothing changes.  The minimum per node is
    combined before it is shuffled, and the edges of each round are a written
    table, so no executor's memory is relied on.  The rounds needed grow with
    the logarithm of the longest chain.
    """
    a, b = F.greatest("a", "b"), F.least("a", "b")
    current = written(edges.filter("a != b").select(a.alias("a"), b.alias("b")).distinct(), label)
    state = _state(current)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(lower, "a")
        small = (
            linked.select("a", F.col("m").alias("b"))
            .unionByName(linked.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")))
            .distinct()
        )
        before, current = current, written(small, label)
        known, state = state, _state(current)
        drop_written(before)
        if state == known:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )


def _state(edges: DataFrame) -> tuple:
    """Count and checksum of the edges: equal for equal sets."""
    row = edges.agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")).alias("s")
    ).first()
    return row["n"], row["x"], row["s"]
