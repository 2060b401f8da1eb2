"""Feature profiles.  Each is one pass over the data, however many features there are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.columns import ref
from gaugeworks.operators.quality import null_counts
from gaugeworks.operators.shape import rows_from_wide


def _per_feature(df: DataFrame, features: Sequence[str], measures: dict, keys: Sequence[str] = ()) -> DataFrame:
    """One row per (group and) feature with the measures of that feature as columns."""
    aggregates = [
        measure(ref(name)).alias(f"{label}_{i}")
        for i, name in enumerate(features)
        for label, measure in measures.items()
    ]
    wide = df.groupBy(*[ref(key) for key in keys]).agg(*aggregates) if keys else df.agg(*aggregates)
    rows = [
        {"feature": F.lit(name), **{label: F.col(f"{label}_{i}") for label in measures}}
        for i, name in enumerate(features)
    ]
    return rows_from_wide(wide, rows, keys)


def describe_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """count, mean, sample stddev, min and max per feature, typed."""
    return _per_feature(
        df,
        features,
        {
            "count": F.count,
            "mean": lambda c: F.avg(c),
            "stddev": lambda c: F.stddev(c),
            "min": lambda c: F.min(c).cast("double"),
            "max": lambda c: F.max(c).cast("double"),
        },
    )


def means_by_label(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    return df.groupBy(ref(label)).agg(*[F.avg(ref(name)).alias(f"{name}_mean") for name in features])


def states_by_label(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Mean, null count and non-null count of every feature per label."""
    return _per_feature(
        df,
        features,
        {
            "mean": F.avg,
            "null_count": lambda c: F.count_if(c.isNull()),
            "non_null_count": F.count,
        },
        [label],
    )


def label_correlations(
    df: DataFrame, features: Sequence[str], label: str, null_as_zero: bool = False
) -> DataFrame:
    """Pearson correlation of every feature with the label.

    Rows where either side is null are left out; ``null_as_zero`` counts nulls
    as 0.0 instead.  A constant side gives null.
    """

    def correlation(column: Column) -> Column:
        x, y = column.cast("double"), ref(label).cast("double")
        if null_as_zero:
            x, y = F.coalesce(x, F.lit(0.0)), F.coalesce(y, F.lit(0.0))
        both = x.isNotNull() & y.isNotNull()
        x, y = F.when(both, x), F.when(both, y)
        spread = F.stddev_pop(x) * F.stddev_pop(y)
        return F.try_divide(F.covar_pop(x, y), spread)

    return _per_feature(df, features, {"correlation": correlation})


def constant_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Is there at most one value, null counting as a value?

    Minimum, maximum and null presence decide it without counting distinct values.
    """

    def constant(column: Column) -> Column:
        varied = F.min(column) != F.max(column)
        has_null = F.max(column.isNull().cast("int")) == 1
        mixed = has_null & (F.count(column) > 0)
        return ~(F.coalesce(varied, F.lit(False)) | F.coalesce(mixed, F.lit(False)))

    return _per_feature(df, features, {"is_constant": constant})


def missing_values(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return null_counts(df, features)
