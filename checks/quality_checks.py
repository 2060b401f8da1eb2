"""Projections, filters, contracts, quality aggregates, ordering, sets and scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import (
    EV,
    LABELLED_SQL,
    LI,
    LI_ORDER,
    LINE_KEY,
    NULL_TIMES_SQL,
    ONE_SERIES,
    REPEATS_SQL,
    SPLIT_SQL,
    STRANGE_LABELS_SQL,
    STRANGE_SQL,
    WIDE,
    WIDE_COLUMNS,
    Registry,
    events,
    labelled,
    lineitem,
    rounded,
    wide,
    with_null_times,
    with_null_values,
    with_repeats,
    with_strange_labels,
    with_strange_values,
)
from gaugeworks.functions import columns as C
from gaugeworks.operators import contracts, quality, sequence, splits
from gaugeworks.operators.batch_reports import BATCH, BatchReports
from gaugeworks.operators.features import with_features
from gaugeworks.operators.training import finite_features
from gaugeworks.sources.landing import with_lineage
from gaugeworks.sources.scratch import scratch_path

checks = Registry()
EPOCH = "CAST(floor(epoch(ts)) AS BIGINT)"


def epoch(name: str, alias: str):
    return C.epoch_seconds(F.col(name)).alias(alias)


# --- projections ---------------------------------------------------------------------------


@checks.add(
    "prj1_lineage_columns",
    """SELECT event_id, value, 'm1' AS machine_id, 'events.csv' AS _source_file, 'abc' AS _source_file_sha256,
              'run-1' AS _run_id FROM events""",
)
def _(spark, sf_dir):
    source = events(spark, sf_dir).select("event_id", "value")
    return with_lineage(source, "m1", "events.csv", "abc", "run-1").drop("_ingested_at")


@checks.add("prj2_drop_temporaries", "SELECT event_id, value * 2 AS doubled FROM events")
def _(spark, sf_dir):
    source = events(spark, sf_dir).select("event_id", (F.col("value") * 1).alias("tmp"))
    return source.withColumn("doubled", F.col("tmp") * 2).drop("tmp")


@checks.add("prj3_odd_column_names", 'SELECT event_id, value AS total, user_id AS machine FROM events')
def _(spark, sf_dir):
    odd = events(spark, sf_dir).select(
        F.col("event_id").alias("Unnamed: 0"), F.col("value").alias("a.b `c`"), F.col("user_id").alias("x y")
    )
    return odd.select(
        C.ref("Unnamed: 0").alias("event_id"), C.ref("a.b `c`").alias("total"), C.ref("x y").alias("machine")
    )


@checks.add(
    "prj4_numeric_columns",
    """UNPIVOT (SELECT sum(event_id)::DOUBLE AS event_id, sum(user_id)::DOUBLE AS user_id,
                       round(sum(value), 4) AS value FROM events)
       ON event_id, user_id, value INTO NAME column_name VALUE total""",
)
def _(spark, sf_dir):
    source = events(spark, sf_dir)
    names = contracts.numeric_columns(source)
    totals = source.agg(*[F.round(F.sum(C.ref(n)).cast("double"), 4).alias(n) for n in names])
    return totals.unpivot([], names, "column_name", "total")


@checks.add(
    "prj5_feature_columns",
    f"""UNPIVOT (SELECT {', '.join(f'round(avg({n}), 6) AS {n}' for n in ('value', *WIDE))} FROM (SELECT *, {WIDE_COLUMNS} FROM events))
        ON COLUMNS(*) INTO NAME feature VALUE mean""",
)
def _(spark, sf_dir):
    train = wide(labelled(spark, sf_dir))
    other = train.withColumn("only_here", F.lit(1.0))
    names = contracts.feature_columns(train, other, excluded=["event_id", "user_id"])
    means = train.agg(*[F.round(F.avg(C.ref(n)), 6).alias(n) for n in names])
    return means.unpivot([], names, "feature", "mean")


GENERATED_SQL = """
WITH made AS (
  SELECT value - lag(value) OVER one AS value_delta, avg(value) OVER frame AS value_rolling_mean_5m,
         stddev_samp(value) OVER frame AS value_rolling_std_5m, min(value) OVER frame AS value_rolling_min_5m,
         max(value) OVER frame AS value_rolling_max_5m, hour(ts)::DOUBLE AS hour, minute(ts)::DOUBLE AS minute,
         (dayofweek(ts) + 1)::DOUBLE AS day_of_week, sin(hour(ts) * 2 * pi() / 24) AS hour_sin, cos(hour(ts) * 2 * pi() / 24) AS hour_cos
  FROM events
  WINDOW one AS (PARTITION BY user_id ORDER BY ts, event_id),
         frame AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
), long AS (UNPIVOT made ON COLUMNS(*) INTO NAME feature VALUE x)
SELECT feature, count(*) AS filled, round(sum(x), 3) + 0.0 AS total, round(min(x), 6) + 0.0 AS low, round(max(x), 6) + 0.0 AS high FROM long GROUP BY feature
"""


@checks.add("prj6_generated_features", GENERATED_SQL)
def _(spark, sf_dir):
    """All ten generated columns."""
    made = with_features(events(spark, sf_dir), EV)
    names = contracts.generated_feature_columns(made.columns)
    kinds = {"filled": F.count, "total": F.sum, "low": F.min, "high": F.max}
    wide = made.agg(*[kind(C.ref(n).cast("double")).alias(f"{n}|{k}") for n in names for k, kind in kinds.items()])
    rows = [F.struct(F.lit(n).alias("feature"), *[C.ref(f"{n}|{k}").alias(k) for k in kinds]) for n in names]
    rounded_to = {"total": 3, "low": 6, "high": 6}
    return wide.select(F.inline(F.array(*rows))).select(
        "feature", "filled", *[(F.round(k, digits) + F.lit(0.0)).alias(k) for k, digits in rounded_to.items()]
    )


@checks.add("prj7_index_column", "SELECT event_id AS seq, value FROM events")
def _(spark, sf_dir):
    raw = events(spark, sf_dir).select(F.col("event_id").alias("Unnamed: 0"), "value")
    return quality.normalize_index(raw)


@checks.add(
    "prj8_schema_listing",
    """SELECT * FROM (VALUES (0, 'event_id', 'bigint'), (1, 'ts', 'timestamp_ntz'), (2, 'user_id', 'bigint'),
         (3, 'event_type', 'string'), (4, 'value', 'double'), (5, 'props', 'string'))
         AS t(position, column_name, data_type), (SELECT count(*) AS non_null FROM events)""",
)
def _(spark, sf_dir):
    source = events(spark, sf_dir)
    total = source.count()
    listed = contracts.schema_listing(source).drop("nullable")
    nulls = quality.null_counts(source)
    return listed.join(nulls, "column_name").select(
        "position", "column_name", "data_type", (F.lit(total) - F.col("null_count")).alias("non_null")
    )


# --- filters and contracts -----------------------------------------------------------------


@checks.add("flt1_rows_with_time", f"SELECT event_id, {EPOCH} AS epoch FROM ({NULL_TIMES_SQL}) WHERE ts IS NOT NULL")
def _(spark, sf_dir):
    source = with_null_times(events(spark, sf_dir))
    return source.filter(F.col("ts").isNotNull()).select("event_id", epoch("ts", "epoch"))


@checks.add(
    "flt2_quarantine",
    f"""SELECT event_id, CASE WHEN ts IS NULL THEN 'rejected' ELSE 'accepted' END AS route,
               CASE WHEN ts IS NULL THEN 'missing_timestamp' END AS reason FROM ({NULL_TIMES_SQL})""",
)
def _(spark, sf_dir):
    accepted, rejected = quality.quarantine(
        with_null_times(events(spark, sf_dir)), quality.missing_time_rule("ts")
    )
    return accepted.select(
        "event_id", F.lit("accepted").alias("route"), F.lit(None).cast("string").alias("reason")
    ).unionByName(
        rejected.select(
            "event_id", F.lit("rejected").alias("route"), F.array_join("reject_reasons", ",").alias("reason")
        )
    )


@checks.add(
    "flt3_invalid_labels",
    f"""SELECT count(*) FILTER (fault_label IS NULL) AS null_labels,
               count(*) FILTER (fault_label NOT IN (0, 1)) AS invalid_labels FROM ({STRANGE_LABELS_SQL})""",
)
def _(spark, sf_dir):
    return quality.invalid_label_counts(with_strange_labels(events(spark, sf_dir)), "fault_label")


@checks.add(
    "flt4_time_range",
    """SELECT event_id, value FROM events
       WHERE ts BETWEEN TIMESTAMP '2024-01-11 23:30:00' AND TIMESTAMP '2024-01-12 06:00:00'""",
)
def _(spark, sf_dir):
    source = events(spark, sf_dir)
    low, high = (C.instant(source, "ts", text) for text in ("2024-01-11 23:30:00", "2024-01-12 06:00:00"))
    return source.filter(F.col("ts").between(low, high)).select("event_id", "value")


@checks.add(
    "flt5_clean_labels",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS fault_label FROM events
       WHERE event_id % 211 <> 0 AND event_id % 223 <> 0 AND event_id % 227 <> 0""",
)
def _(spark, sf_dir):
    text = (
        F.when(F.col("event_id") % 211 == 0, "Infinity")
        .when(F.col("event_id") % 223 == 0, F.lit(None).cast("string"))
        .when(F.col("event_id") % 227 == 0, "broken")
        .when(F.col("event_type") == "error", "1.0")
        .otherwise("0")
    )
    source = events(spark, sf_dir).select("event_id", text.alias("fault_label"))
    return contracts.clean_labels(source, "fault_label")


@checks.add(
    "flt6_finite_features",
    f"SELECT event_id, CASE WHEN isfinite(value) THEN value END AS value FROM ({STRANGE_SQL})",
)
def _(spark, sf_dir):
    source = with_strange_values(events(spark, sf_dir)).select("event_id", "value")
    return finite_features(source, ["value"])


@checks.add("con1_source_contract", "SELECT user_id, count(*) AS row_count FROM events GROUP BY user_id")
def _(spark, sf_dir):
    source = events(spark, sf_dir).withColumnRenamed("ts", "timestamp")
    return contracts.check_source(source).groupBy("user_id").agg(F.count("*").alias("row_count"))


@checks.add("con2_required_columns", f"SELECT fault_label, count(*) AS row_count FROM ({LABELLED_SQL}) GROUP BY 1")
def _(spark, sf_dir):
    source = contracts.require_columns(labelled(spark, sf_dir), ["ts", "fault_label"])
    return source.groupBy("fault_label").agg(F.count("*").alias("row_count"))


@checks.add("con3_required_times", f"SELECT min({EPOCH}) AS first_epoch, max({EPOCH}) AS last_epoch FROM events")
def _(spark, sf_dir):
    source = contracts.require_times(events(spark, sf_dir), "ts")
    return source.agg(
        F.min(C.epoch_seconds(F.col("ts"))).alias("first_epoch"),
        F.max(C.epoch_seconds(F.col("ts"))).alias("last_epoch"),
    )


def refusals(spark, sf_dir, cases):
    """Which checks refuse the events; a check gets the table and raises where it does."""
    source, rows = events(spark, sf_dir), []
    for name, check in cases.items():
        try:
            check(source)
        except contracts.ContractError:
            rows.append((name, True))
        else:
            rows.append((name, False))
    return spark.createDataFrame(rows, "case_name string, refused boolean").withColumn("row_count", F.lit(source.count()).cast("long"))


def refusals_sql(**cases: bool) -> str:
    values = ", ".join(f"('{name}', {str(refused).lower()})" for name, refused in cases.items())
    return f"SELECT * FROM (VALUES {values}) AS t(case_name, refused), (SELECT count(*) AS row_count FROM events)"


@checks.add("con1_source_refusals", refusals_sql(complete=False, no_time=True, no_rows=True))
def _(spark, sf_dir):
    timed = lambda df: df.withColumnRenamed("ts", "timestamp")
    cases = {
        "complete": lambda df: contracts.check_source(timed(df)),
        "no_time": contracts.check_source,
        "no_rows": lambda df: contracts.check_source(timed(df).filter(F.col("event_id") < 0)),
    }
    return refusals(spark, sf_dir, cases)


@checks.add("con2_required_columns_refusals", refusals_sql(present=False, missing=True, other_case=True))
def _(spark, sf_dir):
    cases = {
        "present": lambda df: contracts.require_columns(df, ["ts", "value"]),
        "missing": lambda df: contracts.require_columns(df, ["ts", "fault_label"]),
        "other_case": lambda df: contracts.require_columns(df, ["TS"]),
    }
    return refusals(spark, sf_dir, cases)


@checks.add("con3_required_times_refusals", refusals_sql(complete=False, some_null=True))
def _(spark, sf_dir):
    cases = {
        "complete": lambda df: contracts.require_times(df, "ts"),
        "some_null": lambda df: contracts.require_times(with_null_times(df), "ts"),
    }
    return refusals(spark, sf_dir, cases)


@checks.add(
    "con4_scoring_contract",
    f"SELECT event_id, coalesce(isfinite(value), false) AS valid FROM ({STRANGE_SQL})",
)
def _(spark, sf_dir):
    source = with_strange_values(events(spark, sf_dir)).select("event_id", "value")
    return contracts.scoring_contract(source, ["value"], keys=["event_id"]).select("event_id", "valid")


@checks.add(
    "con5_required_splits",
    """SELECT s.split, count(events.event_id) AS row_count, count(events.event_id) > 0 AS present
       FROM (VALUES ('train', 'click'), ('validation', 'view'), ('test', 'none')) AS s(split, kind)
       LEFT JOIN events ON events.event_type = s.kind GROUP BY s.split""",
)
def _(spark, sf_dir):
    part = F.when(F.col("event_type") == "click", "train").when(F.col("event_type") == "view", "validation")
    return contracts.missing_splits(events(spark, sf_dir).withColumn("split", part))


# --- quality aggregates --------------------------------------------------------------------


@checks.add("agg1_table_shape", "SELECT count(*) AS row_count, 11 AS column_count FROM lineitem")
def _(spark, sf_dir):
    return quality.table_shape(lineitem(spark, sf_dir))


NULL_MIX_SQL = f"SELECT * REPLACE (CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS value) FROM ({NULL_TIMES_SQL})"
EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


def null_mix(spark, sf_dir):
    return with_null_values(with_null_times(events(spark, sf_dir)))


NULL_COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, count(*) - count({name}) AS null_count FROM ({NULL_MIX_SQL})"
    for name in EVENT_COLUMNS
)


@checks.add("agg2_null_counts", NULL_COUNTS_SQL)
def _(spark, sf_dir):
    return quality.null_counts(null_mix(spark, sf_dir))


@checks.add(
    "agg3_null_metrics",
    f"""SELECT 'null_count_' || column_name AS metric_name, null_count AS metric_value,
               CASE WHEN null_count = 0 THEN 'PASS' ELSE 'WARNING' END AS status FROM ({NULL_COUNTS_SQL})""",
)
def _(spark, sf_dir):
    return quality.null_metrics(null_mix(spark, sf_dir))


@checks.add(
    "agg4_time_statistics",
    f"""SELECT count(*) AS total_rows, count(ts) AS valid_timestamps, count(*) - count(ts) AS null_timestamps,
               min(epoch_us(ts)) AS min_timestamp, max(epoch_us(ts)) AS max_timestamp FROM ({NULL_TIMES_SQL})""",
)
def _(spark, sf_dir):
    found = quality.time_statistics(with_null_times(events(spark, sf_dir)), "ts")
    return found.withColumns(
        {n: F.unix_micros(F.col(n).cast("timestamp")) for n in ("min_timestamp", "max_timestamp")}
    )


@checks.add(
    "agg5_sensor_extremes",
    "SELECT "
    + ", ".join(f"min({n}) AS {n}_min, max({n}) AS {n}_max" for n in LI.analog)
    + " FROM lineitem",
)
def _(spark, sf_dir):
    return quality.extremes(lineitem(spark, sf_dir), LI.analog)


@checks.add(
    "agg6_flag_extremes",
    "SELECT "
    + ", ".join(f"min({n}) AS {n}_min, max({n}) AS {n}_max" for n in LI.flags)
    + " FROM lineitem",
)
def _(spark, sf_dir):
    return quality.extremes(lineitem(spark, sf_dir), LI.flags)


@checks.add(
    "agg7_sensor_statistics",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS sensor, min({n}) AS min, max({n}) AS max, round(avg({n}), 6) AS mean,
                   round(stddev_samp({n}), 6) AS stddev FROM lineitem"""
        for n in LI.analog
    ),
)
def _(spark, sf_dir):
    found = quality.sensor_statistics(lineitem(spark, sf_dir), LI.analog)
    return found.select("sensor", "min", "max", *rounded("mean", "stddev"))


@checks.add(
    "agg8_index_statistics",
    """SELECT count(l_orderkey) AS total_rows, count(DISTINCT l_orderkey) AS distinct_indexes,
              min(l_orderkey) AS min_index, max(l_orderkey) AS max_index FROM lineitem""",
)
def _(spark, sf_dir):
    return quality.index_statistics(lineitem(spark, sf_dir), "l_orderkey")


@checks.add(
    "agg9_arithmetic_sequence",
    """SELECT 'events' AS source, 2 * sum(event_id) = count(*) * (min(event_id) + max(event_id)) AS is_sequence,
              sum(event_id)::BIGINT AS index_sum FROM events
       UNION ALL
       SELECT 'lineitem', 2 * sum(l_orderkey) = count(*) * (min(l_orderkey) + max(l_orderkey)),
              sum(l_orderkey)::BIGINT FROM lineitem""",
)
def _(spark, sf_dir):
    found = [
        quality.arithmetic_sequence_check(df, key).select(
            F.lit(name).alias("source"), "is_sequence", F.col("index_sum").cast("long").alias("index_sum")
        )
        for name, df, key in (
            ("events", events(spark, sf_dir), "event_id"),
            ("lineitem", lineitem(spark, sf_dir), "l_orderkey"),
        )
    ]
    return found[0].unionByName(found[1])


@checks.add(
    "agg10_duplicate_times",
    """SELECT epoch_us(l_shipdate) AS ship_micros, count(*) AS copies FROM lineitem
       GROUP BY l_shipdate HAVING count(*) > 1 ORDER BY l_shipdate LIMIT 20""",
)
def _(spark, sf_dir):
    found = quality.duplicate_groups(lineitem(spark, sf_dir), ["l_shipdate"], limit=20)
    return found.select(F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("ship_micros"), "copies")


SECONDS_SQL = f"SELECT {EPOCH} AS epoch FROM ({NULL_TIMES_SQL})"


@checks.add(
    "agg11_excess_duplicates",
    f"SELECT coalesce(sum(n - 1), 0)::BIGINT AS excess_rows FROM (SELECT count(*) AS n FROM ({SECONDS_SQL}) GROUP BY epoch)",
)
def _(spark, sf_dir):
    seconds = with_null_times(events(spark, sf_dir)).select(epoch("ts", "epoch"))
    return quality.duplicate_summary(seconds, ["epoch"]).select("excess_rows")


@checks.add(
    "agg12_duplicated_keys",
    f"SELECT count(*) FILTER (n > 1) AS duplicated_keys FROM (SELECT count(*) AS n FROM ({SECONDS_SQL}) GROUP BY epoch)",
)
def _(spark, sf_dir):
    seconds = with_null_times(events(spark, sf_dir)).select(epoch("ts", "epoch"))
    return quality.duplicate_summary(seconds, ["epoch"]).select("duplicated_keys")


@checks.add(
    "agg13_state_distribution",
    """SELECT 'l_returnflag' AS flag, l_returnflag AS value, count(*) AS row_count FROM lineitem GROUP BY 2
       UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY 2""",
)
def _(spark, sf_dir):
    return quality.state_distribution(lineitem(spark, sf_dir), LI.flags)


GAPS_SQL = f"""SELECT event_id, user_id, {EPOCH} - lag({EPOCH}) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                      AS gap FROM events"""


@checks.add(
    "agg14_gap_summary",
    f"""SELECT min(gap) AS min_gap_seconds, max(gap) AS max_gap_seconds, round(avg(gap), 6) AS avg_gap_seconds,
               count(*) FILTER (gap <> 10) AS unexpected_gaps FROM ({GAPS_SQL})""",
)
def _(spark, sf_dir):
    gaps = sequence.with_time_gap(events(spark, sf_dir), EV, "gap")
    found = quality.gap_summary(gaps, "gap", expected_seconds=10)
    return found.withColumn("avg_gap_seconds", F.round("avg_gap_seconds", 6))


@checks.add(
    "agg15_deduplication_account",
    f"""SELECT (SELECT count(*) FROM ({REPEATS_SQL})) AS rows_before,
               (SELECT count(*) FROM (SELECT DISTINCT * FROM ({REPEATS_SQL}))) AS rows_after,
               (SELECT count(*) FROM ({REPEATS_SQL})) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ({REPEATS_SQL})))
               AS rows_removed""",
)
def _(spark, sf_dir):
    return quality.deduplication_account(with_repeats(events(spark, sf_dir)))


@checks.add(
    "agg16_quality_report",
    f"""WITH m AS ({NULL_MIX_SQL}), n AS ({NULL_COUNTS_SQL}), r AS (
          SELECT 'total_rows' AS metric_name, count(*) AS metric_value FROM m
          UNION ALL SELECT 'null_count_' || column_name, null_count FROM n
          UNION ALL SELECT 'null_timestamp_rows', count(*) - count(ts) FROM m
          UNION ALL SELECT 'duplicate_timestamp_rows', sum(c - 1)::BIGINT FROM (SELECT count(*) AS c FROM m GROUP BY ts)
          UNION ALL SELECT 'duplicate_index_rows', sum(c - 1)::BIGINT FROM (SELECT count(*) AS c FROM m GROUP BY event_id))
        SELECT metric_name, metric_value, 'run-1' AS run_id,
               CASE WHEN metric_name = 'total_rows' THEN 'INFO' WHEN metric_value = 0 THEN 'PASS' ELSE 'WARNING' END
               AS status FROM r""",
)
def _(spark, sf_dir):
    return quality.quality_report(null_mix(spark, sf_dir), "ts", "event_id", "run-1").drop("checked_at")


def batch_reports(df, batch, time, index):
    """Reports of ``df`` landed in three batches, one after the other."""
    spark = df.sparkSession
    path = scratch_path(spark, "batches")
    df.withColumn(BATCH, F.pmod(batch, F.lit(3)).cast("int")).write.partitionBy(BATCH).parquet(path)
    landed, reports = spark.read.parquet(path), BatchReports(spark, scratch_path(spark, "reports"), time, index)
    for number in range(3):
        reports.add(landed, number)
    return reports


@checks.add(
    "agg8_index_statistics_of_batches",
    """SELECT count(l_orderkey) AS total_rows, count(DISTINCT l_orderkey) AS distinct_indexes,
              min(l_orderkey) AS min_index, max(l_orderkey) AS max_index, true AS estimate_is_near FROM lineitem""",
)
def _(spark, sf_dir):
    reports = batch_reports(lineitem(spark, sf_dir), F.col("l_linenumber"), "l_shipdate", "l_orderkey")
    near = F.abs(F.col("estimated_indexes") - F.col("distinct_indexes")) <= 0.08 * F.col("distinct_indexes")
    return reports.index_statistics().withColumn("estimate_is_near", near).drop("estimated_indexes")


@checks.add("agg16_quality_report_of_batches", checks["agg16_quality_report"].sql)
def _(spark, sf_dir):
    reports = batch_reports(null_mix(spark, sf_dir), F.col("user_id"), "ts", "event_id")
    return reports.quality_report("run-1").drop("checked_at")


# --- order and sets ------------------------------------------------------------------------

SHOWN = ("event_id", "user_id", "value")


@checks.add("ord2_first_rows", "SELECT event_id, user_id, value FROM events ORDER BY ts, event_id LIMIT 10")
def _(spark, sf_dir):
    return sequence.first_rows(events(spark, sf_dir), ONE_SERIES, 10, SHOWN)


@checks.add("ord2_last_rows", "SELECT event_id, user_id, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 10")
def _(spark, sf_dir):
    return sequence.last_rows(events(spark, sf_dir), ONE_SERIES, 10, SHOWN)


@checks.add(
    "ord3_display_sample",
    f"SELECT {', '.join(LINE_KEY)} FROM lineitem ORDER BY {LI_ORDER} LIMIT 5",
)
def _(spark, sf_dir):
    return sequence.first_rows(lineitem(spark, sf_dir), LI, 5, LINE_KEY)


@checks.add(
    "ord4_first_test_rows",
    """SELECT event_id, value FROM events WHERE ts > TIMESTAMP '2024-01-26 11:50:50'
       ORDER BY ts, event_id LIMIT 36""",
)
def _(spark, sf_dir):
    source = events(spark, sf_dir)
    test = source.filter(F.col("ts") > C.instant(source, "ts", "2024-01-26 11:50:50"))
    return sequence.first_rows(test, ONE_SERIES, 36, ["event_id", "value"])


@checks.add(
    "ord5_exemplar_rows",
    f"""SELECT user_id, event_id, fault_label, CASE WHEN isfinite(value) THEN value END AS value FROM (
          SELECT * EXCLUDE (value), value FROM ({LABELLED_SQL.replace('FROM events', f'FROM ({STRANGE_SQL}) AS e')})
        ) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY fault_label DESC, ts, event_id) = 1""",
)
def _(spark, sf_dir):
    source = with_strange_values(labelled(spark, sf_dir))
    exemplars = sequence.exemplar_rows(source, EV)
    return finite_features(exemplars, ["value"]).select("user_id", "event_id", "fault_label", "value")


@checks.add("set1_exact_duplicates", f"SELECT DISTINCT event_id, user_id, value FROM ({REPEATS_SQL})")
def _(spark, sf_dir):
    return quality.remove_exact_duplicates(with_repeats(events(spark, sf_dir))).select("event_id", "user_id", "value")


@checks.add("set2_joined_classes", f"SELECT event_id, fault_label FROM ({LABELLED_SQL})")
def _(spark, sf_dir):
    source = labelled(spark, sf_dir).select("event_id", "fault_label")
    return source.filter("fault_label = 1").unionByName(source.filter("fault_label = 0"))


@checks.add("set3_distinct_values", "SELECT DISTINCT user_id, event_type FROM events")
def _(spark, sf_dir):
    return events(spark, sf_dir).select("user_id", "event_type").distinct()


@checks.add(
    "set4_partition_check",
    f"""SELECT count(*) AS total_rows, count(*) FILTER (split = 'train') AS train_rows,
              count(*) FILTER (split = 'validation') AS validation_rows, count(*) FILTER (split = 'test') AS test_rows,
              0::BIGINT AS rejected_rows, 0::BIGINT AS shared_keys, true AS adds_up, true AS none_empty FROM ({SPLIT_SQL})""",
)
def _(spark, sf_dir):
    split = splits.stratified_split(labelled(spark, sf_dir), "fault_label", ["event_id"])
    return splits.partition_check(split, ["event_id"])


# --- scalars -------------------------------------------------------------------------------


@checks.add(
    "scl1_to_scl4_time_functions",
    f"""SELECT event_id, {EPOCH} AS epoch, hour(ts)::INTEGER AS hour, minute(ts)::INTEGER AS minute,
               (dayofweek(ts) + 1)::INTEGER AS day_of_week, round(sin(2 * pi() * hour(ts) / 24), 6) AS hour_sin,
               round(cos(2 * pi() * hour(ts) / 24), 6) AS hour_cos FROM events""",
)
def _(spark, sf_dir):
    hour = F.hour("ts")
    sine, cosine = C.cyclic_hour(hour)
    return events(spark, sf_dir).select(
        "event_id", epoch("ts", "epoch"), hour.alias("hour"), F.minute("ts").alias("minute"),
        F.dayofweek("ts").alias("day_of_week"), F.round(sine, 6).alias("hour_sin"), F.round(cosine, 6).alias("hour_cos"),
    )


@checks.add(
    "scl5_to_scl8_scl11_conditionals",
    f"""SELECT event_id, CASE WHEN value > 100 THEN 'high' WHEN value > 10 THEN 'middle' ELSE 'low' END AS level,
               greatest(1, CAST(floor(value * CAST(0.7 AS DOUBLE)) AS INTEGER)) AS raised,
               least(value, 50.0::DOUBLE) AS lowered, coalesce(ts IS NULL, true) AS without_time,
               event_type IN ('error', 'view') AS chosen,
               coalesce(ts >= TIMESTAMP '2024-01-15 00:00:00', false) AS second_half,
               CASE WHEN value / 500.0::DOUBLE >= 0.05::DOUBLE THEN 1 ELSE 0 END AS flagged FROM ({NULL_TIMES_SQL})""",
)
def _(spark, sf_dir):
    source = with_null_times(events(spark, sf_dir))
    value = F.col("value")
    return source.select(
        "event_id",
        F.when(value > 100, "high").when(value > 10, "middle").otherwise("low").alias("level"),
        F.greatest(F.lit(1), F.floor(value * 0.7).cast("int")).alias("raised"),
        F.least(value, F.lit(50.0)).alias("lowered"),
        F.col("ts").isNull().alias("without_time"),
        F.col("event_type").isin("error", "view").alias("chosen"),
        F.coalesce(F.col("ts") >= C.instant(source, "ts", "2024-01-15 00:00:00"), F.lit(False)).alias("second_half"),
        C.at_threshold(value / 500.0, 0.05).alias("flagged"),
    )


@checks.add(
    "scl9_run_columns",
    """SELECT event_id, 'run-1' AS run_id, true AS stamped, true AS named FROM events""",
)
def _(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id",
        F.lit("run-1").alias("run_id"),
        (F.current_timestamp() > F.col("ts").cast("timestamp")).alias("stamped"),
        F.expr("uuid()").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$").alias("named"),
    )


@checks.add(
    "scl10_identifiers",
    """SELECT event_id, regexp_full_match(event_type || CASE WHEN event_id % 2 = 0 THEN '_1' ELSE '-1' END,
                                          '[A-Za-z_][A-Za-z0-9_]*') AS is_identifier FROM events""",
)
def _(spark, sf_dir):
    name = F.concat("event_type", F.when(F.col("event_id") % 2 == 0, "_1").otherwise("-1"))
    return events(spark, sf_dir).select("event_id", C.is_identifier(name).alias("is_identifier"))
