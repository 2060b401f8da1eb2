"""Counts, ranges, duplicates and gaps: what a quality report is made of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.columns import ref, refs
from gaugeworks.operators.shape import rows_from_wide
from gaugeworks.roles import INDEX_ALIASES

ACCEPTED, REJECTED = "accepted", "rejected"


def find_index_column(columns: Sequence[str], aliases: Sequence[str] = INDEX_ALIASES) -> str | None:
    """First alias present among the columns, in the order of ``aliases``."""
    return next((alias for alias in aliases if alias in columns), None)


def normalize_index(df: DataFrame, name: str = "seq", aliases: Sequence[str] = INDEX_ALIASES) -> DataFrame:
    """Rename the index column, under whichever alias it came, to one name."""
    found = find_index_column(df.columns, aliases)
    return df if found is None else df.withColumnRenamed(found, name)


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).withColumn("column_count", F.lit(len(df.columns)))


def null_counts_wide(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = list(columns or df.columns)
    return df.agg(*[F.count_if(ref(name).isNull()).alias(name) for name in names])


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, null_count)`` for every column, from one pass."""
    names = list(columns or df.columns)
    return rows_from_wide(
        null_counts_wide(df, names),
        [{"column_name": F.lit(name), "null_count": ref(name)} for name in names],
    )


def _status(value: Column) -> Column:
    return F.when(value == 0, F.lit("PASS")).otherwise(F.lit("WARNING"))


def null_metrics(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null counts as metric rows with a status."""
    return null_count_metrics(null_counts(df, columns))


def null_count_metrics(counts: DataFrame) -> DataFrame:
    return counts.select(
        F.concat(F.lit("null_count_"), "column_name").alias("metric_name"),
        F.col("null_count").alias("metric_value"),
        _status(F.col("null_count")).alias("status"),
    )


def time_statistics(df: DataFrame, time: str) -> DataFrame:
    moment = ref(time)
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count(moment).alias("valid_timestamps"),
        F.count_if(moment.isNull()).alias("null_timestamps"),
        F.min(moment).alias("min_timestamp"),
        F.max(moment).alias("max_timestamp"),
    )


def extremes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``<c>_min`` and ``<c>_max`` of every column in one row."""
    return df.agg(
        *[F.min(ref(name)).alias(f"{name}_min") for name in columns],
        *[F.max(ref(name)).alias(f"{name}_max") for name in columns],
    )


def sensor_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Min, max, mean and sample standard deviation per column, one row each."""
    wide = df.agg(
        *[
            aggregate(ref(name)).alias(f"{kind}_{i}")
            for i, name in enumerate(columns)
            for kind, aggregate in (("min", F.min), ("max", F.max), ("mean", F.avg), ("stddev", F.stddev))
        ]
    )
    return rows_from_wide(
        wide,
        [
            {
                "sensor": F.lit(name),
                **{kind: F.col(f"{kind}_{i}").cast("double") for kind in ("min", "max", "mean", "stddev")},
            }
            for i, name in enumerate(columns)
        ],
    )


def index_statistics(df: DataFrame, index: str, approximate: bool = False) -> DataFrame:
    column = ref(index)
    distinct = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
    return df.agg(
        F.count(column).alias("total_rows"),
        distinct.alias("distinct_indexes"),
        F.min(column).alias("min_index"),
        F.max(column).alias("max_index"),
    )


def arithmetic_sequence_check(df: DataFrame, index: str) -> DataFrame:
    """Does the index add up like ``min, min+1, ..., max``?  Exact decimal sums."""
    column = ref(index)
    totals = df.agg(
        F.count(column).alias("row_count"),
        F.min(column).alias("min_index"),
        F.max(column).alias("max_index"),
        F.sum(column.cast("decimal(20,0)")).alias("index_sum"),
        F.count_if(column != F.floor(column)).alias("__fractions"),
    )
    ends = F.col("min_index").cast("decimal(20,0)") + F.col("max_index").cast("decimal(20,0)")
    doubled = F.col("index_sum") * 2
    adds_up = doubled == F.col("row_count").cast("decimal(20,0)") * ends
    return totals.withColumn("is_sequence", adds_up & (F.col("__fractions") == 0)).drop("__fractions")


def duplicate_groups(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame:
    """Key values that occur more than once, in key order."""
    groups = df.groupBy(*refs(keys)).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)
    if limit is None:
        return groups
    return groups.orderBy(*refs(keys)).limit(limit)


def duplicate_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Duplicated key values and rows in excess of one per key; null is a key too."""
    groups = df.groupBy(*refs(keys)).agg(F.count("*").alias("copies"))
    return groups.agg(
        F.count_if(F.col("copies") > 1).alias("duplicated_keys"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("excess_rows"),
    )


def state_distribution(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Rows per value of every flag.

    The flags are counted jointly first: a handful of state combinations
    remain and only those are made long.
    """
    joint = df.groupBy(*refs(flags)).agg(F.count("*").alias("__n"))
    entries = [
        {"flag": F.lit(name), "value": ref(name).cast("string"), "__n": F.col("__n")} for name in flags
    ]
    return rows_from_wide(joint, entries).groupBy("flag", "value").agg(F.sum("__n").alias("row_count"))


def gap_summary(df: DataFrame, gap: str, expected_seconds: int = 10) -> DataFrame:
    column = ref(gap)
    return df.agg(
        F.min(column).alias("min_gap_seconds"),
        F.max(column).alias("max_gap_seconds"),
        F.avg(column).alias("avg_gap_seconds"),
        F.count_if(column != expected_seconds).alias("unexpected_gaps"),
    )


def remove_exact_duplicates(df: DataFrame, lineage: Sequence[str] = ()) -> DataFrame:
    """One row of those that are equal in every column but ``lineage``; the smallest lineage stays."""
    beside = [name for name in lineage if name in df.columns]
    if not beside:
        return df.dropDuplicates()
    keys = [name for name in df.columns if name not in beside]
    first = F.min(F.struct(*refs(beside))).alias("__first")
    return df.groupBy(*refs(keys)).agg(first).select(
        *[F.col("__first").getField(name).alias(name) if name in beside else ref(name) for name in df.columns]
    )


def deduplication_account(df: DataFrame) -> DataFrame:
    """Rows before and after removing exact duplicates."""
    groups = df.groupBy(*refs(df.columns)).agg(F.count("*").alias("__copies"))
    totals = groups.agg(
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("rows_before"),
        F.count("*").alias("rows_after"),
    )
    return totals.withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def report_metric(name: str, value: Column, status: Column | None = None) -> dict[str, Column]:
    return {
        "metric_name": F.lit(name),
        "metric_value": value.cast("long"),
        "status": _status(value) if status is None else status,
    }


def duplicate_metric(role: str, excess: Column) -> dict[str, Column]:
    return report_metric({"time": "duplicate_timestamp_rows", "index": "duplicate_index_rows"}[role], excess)


def quality_report(df: DataFrame, time: str, index: str | None, run_id: str) -> DataFrame:
    """Every quality metric as ``(metric_name, metric_value, status, run_id, checked_at)``."""
    names = list(df.columns)
    wide = df.agg(
        F.count("*").alias("total"),
        *[F.count_if(ref(name).isNull()).alias(f"null_{i}") for i, name in enumerate(names)],
    )

    rows = [report_metric("total_rows", F.col("total"), F.lit("INFO"))]
    rows += [report_metric(f"null_count_{name}", F.col(f"null_{i}")) for i, name in enumerate(names)]
    rows.append(report_metric("null_timestamp_rows", F.col(f"null_{names.index(time)}")))
    report = rows_from_wide(wide, rows)
    for role, key in (("time", time), ("index", index)):
        if key is not None:
            excess = duplicate_summary(df, [key])
            report = report.unionByName(rows_from_wide(excess, [duplicate_metric(role, F.col("excess_rows"))]))
    return report.withColumns({"run_id": F.lit(run_id), "checked_at": F.current_timestamp()})


def with_reject_reasons(df: DataFrame, rules: dict[str, Column], name: str = "reject_reasons") -> DataFrame:
    """Array of the names of the rules a row breaks (a rule is a condition for rejection)."""
    broken = [F.when(F.coalesce(condition, F.lit(False)), F.lit(rule)) for rule, condition in rules.items()]
    return df.withColumn(name, F.array_compact(F.array(*broken)))


def with_verdict(df: DataFrame, rules: dict[str, Column], name: str = "reject_reasons") -> DataFrame:
    """Reasons and ``route``: written once and partitioned by the route, both outputs come from one pass."""
    route = F.when(F.size(name) == 0, ACCEPTED).otherwise(REJECTED)
    return with_reject_reasons(df, rules, name).withColumn("route", route)


def quarantine(df: DataFrame, rules: dict[str, Column], name: str = "reject_reasons") -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)``; only rejected rows carry their reasons."""
    judged = with_reject_reasons(df, rules, name)
    return (
        judged.filter(F.size(name) == 0).drop(name),
        judged.filter(F.size(name) > 0),
    )


def missing_time_rule(time: str) -> dict[str, Column]:
    return {"missing_timestamp": ref(time).isNull()}


def invalid_label_counts(df: DataFrame, label: str) -> DataFrame:
    """Null labels and labels outside {0, 1}, counted apart."""
    return df.agg(
        F.count_if(ref(label).isNull()).alias("null_labels"),
        F.count_if(~ref(label).isin(0, 1)).alias("invalid_labels"),
    )
