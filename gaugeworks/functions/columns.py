"""Scalar expressions shared by the operators."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: identifiers accepted for catalogs, schemas and tables.
IDENTIFIER_PATTERN = r"[A-Za-z_][A-Za-z0-9_]*"


def ref(name: str) -> Column:
    """Reference a column whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def refs(names: Iterable[str]) -> list[Column]:
    return [ref(name) for name in names]


def check_identifier(value: str, what: str = "identifier") -> str:
    if not re.fullmatch(IDENTIFIER_PATTERN, value):
        raise ValueError(f"invalid {what}: {value!r}")
    return value


def is_identifier(column: Column) -> Column:
    return column.rlike(f"^{IDENTIFIER_PATTERN}$")


def epoch_seconds(column: Column) -> Column:
    """Whole seconds since 1970 of a timestamp with or without time zone."""
    return F.unix_timestamp(column)


def instant(df: DataFrame, time: str, text: str) -> Column:
    """Timestamp literal in the type of ``df[time]``.

    Comparing the raw column with a literal of its own type lets the filter
    reach the Parquet scan; a cast on the column would not.
    """
    return F.lit(text).cast(df.schema[time].dataType)


def cyclic_hour(hour: Column) -> tuple[Column, Column]:
    angle = hour * F.lit(2.0 * math.pi / 24.0)
    return F.sin(angle), F.cos(angle)


def finite_or_null(column: Column, data_type: T.DataType | None = None) -> Column:
    """Null for NaN and the infinities; other values unchanged."""
    if data_type is not None and not isinstance(data_type, (T.DoubleType, T.FloatType)):
        return column
    value = column.cast("double")
    bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(~bad, column)


def is_finite(column: Column) -> Column:
    """True for a present, finite number; never null."""
    value = column.cast("double")
    return F.coalesce(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), F.lit(False))


def clean_label(column: Column) -> Column:
    """Coerce a label to a number; null for text, NaN, infinities and nulls."""
    number = column.cast("string").try_cast("double")
    return finite_or_null(number)


def at_threshold(probability: Column, threshold: float | Column) -> Column:
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (probability >= limit).cast("int")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, null when the denominator is zero or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(ratio(numerator, denominator), F.lit(0.0))


def seeded_digest(seed: int, keys: Iterable[str]) -> Column:
    """md5 of seed and row key: a random order that no partitioning can change.

    Of several keys each part carries its length, so no two keys read alike;
    a null is told from an empty text.
    """
    names = list(keys)
    texts = [ref(key).cast("string") for key in names]
    if len(names) > 1:
        texts = [F.concat(F.length(text).cast("string"), F.lit(":"), text) for text in texts]
    parts = [F.coalesce(text, F.lit("\x00null")) for text in texts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
