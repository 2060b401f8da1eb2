"""Contracts: conditions a table must meet before work starts on it."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.columns import clean_label, is_finite, ref
from gaugeworks.operators.shape import rows_from_wide
from gaugeworks.roles import INDEX_ALIASES


class ContractError(ValueError):
    """A table does not meet its contract."""


def schema_listing(df: DataFrame) -> DataFrame:
    """``(position, column_name, data_type, nullable)`` of a DataFrame."""
    rows = [
        (position, field.name, field.dataType.simpleString(), field.nullable)
        for position, field in enumerate(df.schema.fields)
    ]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean"
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema.fields if isinstance(field.dataType, T.NumericType)]


# Columns that never are model features.
NON_FEATURES = ("timestamp", "datetime", "date", "failure_id", "fault_label")


def feature_columns(train: DataFrame, other: DataFrame, excluded: Iterable[str] = ()) -> list[str]:
    """Numeric columns of both frames, in the order of ``train``, without labels, times and index."""
    shared = set(numeric_columns(other))
    left_out = {*NON_FEATURES, *INDEX_ALIASES, "seq", *excluded}
    return [name for name in numeric_columns(train) if name in shared and name not in left_out]


def generated_feature_columns(columns: Sequence[str]) -> list[str]:
    """Columns made by the feature step, recognised by name."""
    fixed = {"hour", "minute", "day_of_week", "hour_sin", "hour_cos"}
    return [name for name in columns if name.endswith("_delta") or "_rolling_" in name or name in fixed]


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ContractError(f"missing required columns: {missing}")
    return df


def check_header(header: Sequence[str]) -> None:
    """Header of a raw file as written; Spark would rename duplicates silently."""
    repeated = sorted(name for name, n in Counter(header).items() if n > 1)
    if not header:
        raise ContractError("the source has no columns")
    if repeated:
        raise ContractError(f"duplicate column names: {repeated}")


def check_columns(columns: Sequence[str], time: str = "timestamp", machine: str = "machine_id") -> None:
    """A time column is there, a machine column is not yet."""
    check_header(list(columns))
    if time not in columns:
        raise ContractError(f"required column {time} is missing")
    if machine in columns:
        raise ContractError(f"the source already has a column {machine}")


def check_source(df: DataFrame, time: str = "timestamp", machine: str = "machine_id") -> DataFrame:
    """Columns present and unique, with a time, without machine column, at least one row."""
    check_columns(df.columns, time, machine)
    if df.isEmpty():
        raise ContractError("the source has no rows")
    return df


def require_times(df: DataFrame, time: str) -> DataFrame:
    """Stop at the first reading without a time."""
    if not df.filter(ref(time).isNull()).isEmpty():
        raise ContractError(f"null values in {time}")
    return df


def clean_labels(df: DataFrame, label: str) -> DataFrame:
    """Numeric 0/1 labels; rows without a usable label are dropped, other values stop the job."""
    cleaned = (
        df.withColumn(label, clean_label(ref(label)))
        .filter(ref(label).isNotNull())
        .withColumn(label, ref(label).cast("int"))
    )
    strange = cleaned.filter(~ref(label).isin(0, 1)).limit(1).collect()
    if strange:
        raise ContractError(f"labels must be 0 or 1, found {strange[0][label]}")
    return cleaned


def class_counts(df: DataFrame, label: str) -> dict[int, int]:
    """Rows per class; the label domain {0, 1} bounds what is collected."""
    rows = df.filter(ref(label).isin(0, 1)).groupBy(ref(label).alias("label")).count().collect()
    return {int(row["label"]): row["count"] for row in rows}


def feature_differences(columns: Sequence[str], features: Sequence[str]) -> dict[str, list[str]]:
    return {
        "missing": [name for name in features if name not in columns],
        "unexpected": [name for name in columns if name not in features],
    }


def scoring_contract(df: DataFrame, features: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Keys and features in model order plus ``valid``: every feature is a finite number."""
    found = feature_differences([name for name in df.columns if name not in keys], features)
    if found["missing"] or found["unexpected"]:
        raise ContractError(f"features do not match the model: {found}")
    return with_validity(df.select(*[ref(name) for name in (*keys, *features)]), features)


def with_validity(df: DataFrame, features: Sequence[str], name: str = "valid") -> DataFrame:
    valid: Column = F.lit(True)
    for feature in features:
        valid = valid & is_finite(ref(feature))
    return df.withColumn(name, valid)


def missing_splits(df: DataFrame, split: str = "split", required: Sequence[str] = ("train", "validation", "test")) -> DataFrame:
    """Rows per required split, zero included, and whether it is there."""
    wide = df.agg(*[F.count_if(ref(split) == name).alias(f"n_{name}") for name in required])
    return rows_from_wide(
        wide,
        [
            {"split": F.lit(name), "row_count": F.col(f"n_{name}"), "present": F.col(f"n_{name}") > 0}
            for name in required
        ],
    )


def check_model(feature_count: int, features: Sequence[str], model_width: int) -> None:
    if not feature_count == len(features) == model_width:
        raise ContractError(
            f"recorded {feature_count} features, listed {len(features)}, model expects {model_width}"
        )
