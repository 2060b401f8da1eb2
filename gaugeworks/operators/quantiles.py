"""Exact quantiles with bounded memory, by radix selection.

``percentile`` and ``median`` keep every distinct value of a column in one
aggregation buffer, and sketches meet in one task.  Here every value becomes a
64-bit integer of the same order, and rows are counted per column and leading
bits.  The counts tell which prefix holds a wanted rank; only rows with that
prefix are counted again, by their next bits.  Counts are combined in each task
before they are shuffled, so that the work per pass is a scan and what travels
is at most some thousand counts per task and prefix.

The same steps serve a table of any size.  A prefix with few rows is told apart
by all its remaining bits at once: two or three passes are usual, five are the
most there can be.
"""

from __future__ import annotations

import math
import struct
from bisect import bisect_right
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.columns import ref

# Bits left out by the prefixes of each pass: sign and exponent first, then 13 more bits at a time.
SHIFTS = (52, 39, 26, 13, 0)
# A prefix with at most so many rows is refined to single values at once.
LEAF_ROWS = 8_192

_INFINITE, _NOT_A_NUMBER = 0x7FF << 52, 0x7FF8 << 48
_NORMAL = 2.0**-1022


@dataclass(frozen=True)
class _Bracket:
    """Rows of one column whose keys begin with ``prefix``, all other bits but ``shift`` being left out."""

    column: str
    prefix: int | None
    shift: int
    below: int = 0
    rows: int = 0

    def finer(self, leaf_rows: int) -> int:
        """The bits left out by the next pass."""
        if self.prefix is None:
            return SHIFTS[0]
        if self.rows <= leaf_rows:
            return 0
        return next(shift for shift in SHIFTS if shift < self.shift)

    def inside(self) -> Column:
        value = ref(self.column).cast("double")
        if self.prefix is None:
            return value.isNotNull()
        low, high = self.prefix << self.shift, ((self.prefix + 1) << self.shift) - 1
        # The bounds are plain values, so that a scan can skip row groups.
        if low > _INFINITE:
            return F.isnan(value)
        if high >= _NOT_A_NUMBER:
            upper = value.isNotNull()
        else:
            upper = ~F.isnan(value) if high >= _INFINITE else value <= F.lit(value_of(high))
        return upper if low < -_INFINITE else (value >= F.lit(value_of(low))) & upper


def value_of(key: int) -> float:
    """The number whose key it is."""
    return math.copysign(struct.unpack("<d", struct.pack("<q", abs(key)))[0], key)


def with_order_key(df: DataFrame, value: str, key: str) -> DataFrame:
    """Add a 64-bit integer in the order of a double column, by its sign, exponent and fraction.

    Zeros of both signs are equal and NaN comes last.  Every step is exact: the
    exponent is taken from a logarithm and corrected where that is off by one,
    and all products are with powers of two.
    """
    size, exponent, part = "__size", "__exponent", "__part"

    def scaled(by: Column) -> Column:
        half = F.shiftright(by, 1)
        return F.col(size) * F.pow(F.lit(2.0), -half) * F.pow(F.lit(2.0), half - by)

    plain = F.when(F.isnan(size) | (F.col(size) == float("inf")) | (F.col(size) < _NORMAL), 1.0).otherwise(F.col(size))
    staged = df.withColumn(size, F.abs(ref(value)))
    staged = staged.withColumn(exponent, F.floor(F.log2(plain)).cast("long"))
    staged = staged.withColumn(part, scaled(F.col(exponent)))
    over, under = F.col(part) >= 2.0, F.col(part) < 1.0
    staged = staged.withColumns(
        {
            exponent: F.col(exponent) + F.when(over, 1).when(under, -1).otherwise(0),
            part: F.col(part) * F.when(over, 0.5).when(under, 2.0).otherwise(1.0),
        }
    )
    whole = F.shiftleft(F.col(exponent) + 1023, 52) + ((F.col(part) - 1.0) * 2.0**52).cast("long")
    tiny = (F.col(size) * 2.0**537 * 2.0**537).cast("long")
    magnitude = (
        F.when(F.isnan(size), F.lit(_NOT_A_NUMBER))
        .when(F.col(size) == float("inf"), F.lit(_INFINITE))
        .when(F.col(size) < _NORMAL, tiny)
        .otherwise(whole)
    )
    return staged.withColumn(key, F.when(ref(value) < 0, -magnitude).otherwise(magnitude)).drop(size, exponent, part)


def exact_quantiles(
    df: DataFrame,
    wanted: Mapping[str, Sequence[float]],
    discrete: bool = False,
    leaf_rows: int = LEAF_ROWS,
) -> dict[str, list[float | None]]:
    """Quantiles of numeric columns; nulls are left out, an empty column gives None.

    Linear interpolation between ranks by default; ``discrete`` returns the
    first value whose cumulative share reaches the probability.  NaN counts as
    the largest value (see ``finite_or_null``).  Numbers are compared as
    doubles.
    """
    everything = [_Bracket(name, None, 64) for name in wanted]
    counts = _counts(df, everything, leaf_rows)
    ranks = {
        name: [_ranks(probability, sum(n for _, n in counts[bracket]), discrete) for probability in wanted[name]]
        for name, bracket in zip(wanted, everything)
    }
    place = {
        (bracket.column, rank): _holder(bracket, counts[bracket], rank, leaf_rows)
        for bracket in everything
        if counts[bracket]
        for first, last, _ in ranks[bracket.column]
        for rank in (first, last)
    }
    while open_brackets := {bracket for bracket in place.values() if bracket.shift}:
        counts = _counts(df, sorted(open_brackets, key=lambda b: (b.column, b.prefix)), leaf_rows)
        place = {
            (name, rank): _holder(bracket, counts[bracket], rank, leaf_rows) if bracket.shift else bracket
            for (name, rank), bracket in place.items()
        }
    found = {at: value_of(bracket.prefix) for at, bracket in place.items()}

    def between(name: str, first: int, last: int, weight: float) -> float | None:
        if (name, first) not in found:
            return None
        low, high = found[name, first], found[name, last]
        return low if weight == 0.0 or low == high else low + weight * (high - low)

    return {name: [between(name, *rank) for rank in ranks[name]] for name in wanted}


def exact_medians(df: DataFrame, columns: Sequence[str], leaf_rows: int = LEAF_ROWS) -> dict[str, float | None]:
    found = exact_quantiles(df, {name: [0.5] for name in columns}, leaf_rows=leaf_rows)
    return {name: values[0] for name, values in found.items()}


def _ranks(probability: float, rows: int, discrete: bool) -> tuple[int, int, float]:
    """Ranks from 0 of the two neighbours, and how far the quantile lies between them."""
    if discrete:
        rank = min(rows - 1, max(0, math.ceil(probability * rows) - 1))
        return rank, rank, 0.0
    position = probability * (rows - 1)
    first = math.floor(position)
    return first, min(rows - 1, math.ceil(position)), position - first


def prefix_counts(df: DataFrame, brackets: Sequence[_Bracket], leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``bracket, prefix, n``: the rows of each bracket by the bits that the next pass looks at."""
    entries = [
        F.when(
            bracket.inside(),
            F.struct(
                F.lit(number).alias("bracket"),
                F.lit(bracket.finer(leaf_rows)).alias("shift"),
                ref(bracket.column).cast("double").alias("value"),
            ),
        )
        for number, bracket in enumerate(brackets)
    ]
    rows = df.select(F.explode(F.array(*entries)).alias("e")).filter(F.col("e").isNotNull()).select("e.*")
    keyed = with_order_key(rows, "value", "key")
    return keyed.groupBy("bracket", F.expr("shiftright(key, shift)").alias("prefix")).agg(F.count("*").alias("n"))


def _counts(df: DataFrame, brackets: Sequence[_Bracket], leaf_rows: int) -> dict[_Bracket, list[tuple[int, int]]]:
    """At most 8,192 counts per bracket: that is what bits or rows it has."""
    found: dict[_Bracket, list[tuple[int, int]]] = {bracket: [] for bracket in brackets}
    if brackets:
        for row in prefix_counts(df, brackets, leaf_rows).collect():
            found[brackets[row["bracket"]]].append((row["prefix"], row["n"]))
    return {bracket: sorted(counts) for bracket, counts in found.items()}


def _holder(bracket: _Bracket, counts: list[tuple[int, int]], rank: int, leaf_rows: int) -> _Bracket:
    """The finer prefix in which the row of a rank lies."""
    upto = list(accumulate((n for _, n in counts), initial=bracket.below))
    at = bisect_right(upto, rank) - 1
    prefix, rows = counts[at]
    return _Bracket(bracket.column, prefix, bracket.finer(leaf_rows), upto[at], rows)
