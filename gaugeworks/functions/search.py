"""Position of a row among sorted boundaries, as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def boundaries_not_above(boundaries: Column, most: int, key: Column) -> Column:
    """Number of boundaries ``<= key`` in a sorted array of at most ``most`` items.

    A bisection over the array: the cost grows with log2(most) per row.
    Positions past the end read as null and count as above the key.
    """
    if most == 0:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << bit) for bit in range(most.bit_length() - 1, -1, -1)])

    def position(one: Column) -> Column:
        return F.aggregate(
            steps,
            F.lit(0),
            lambda below, step: F.when(
                F.try_element_at(boundaries, below + step) <= one, below + step
            ).otherwise(below),
        )

    # Through a one-element array the key is built once, not once per step.
    return F.element_at(F.transform(F.array(key), position), 1)
