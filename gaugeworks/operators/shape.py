"""Small reshaping helpers for one-row aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_from_wide(wide: DataFrame, rows: Sequence[Mapping[str, Column]], keep: Sequence[str] = ()) -> DataFrame:
    """Turn each wide row into ``len(rows)`` long rows.

    Meant for aggregates: the table is aggregated in one pass over wide
    columns and only the result is made long, never the data.
    """
    entries = [F.struct(*[value.alias(name) for name, value in row.items()]) for row in rows]
    return wide.select(*keep, F.inline(F.array(*entries)))
