"""Ordered windows, labels, features, profiles, splits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import (
    EV,
    LABELLED_SQL,
    LI,
    LI_ORDER,
    LINE_KEY,
    ONE_SERIES,
    SPLIT_SQL,
    STRANGE_LABELS_SQL,
    WIDE,
    WIDE_LABELLED_SQL,
    WINDOWS,
    Registry,
    events,
    labelled,
    lineitem,
    with_strange_labels,
    rounded,
    wide_labelled,
)
from gaugeworks.functions.columns import epoch_seconds, seeded_digest
from gaugeworks.operators import labeling, profiling, ranges, sequence, splits
from gaugeworks.operators.features import with_features
from gaugeworks.sources.scratch import scratch_path
from gaugeworks.streaming.windows import run_windows

checks = Registry()
EPOCH = "CAST(floor(epoch(ts)) AS BIGINT)"
BY_USER = "PARTITION BY user_id ORDER BY ts, event_id"
FRAME = "ROWS BETWEEN 29 PRECEDING AND CURRENT ROW"
STREAM_CUTS = ("2024-01-08 00:00:00", "2024-01-16 00:00:00", "2024-01-24 00:00:00")
KINDS = ("mean", "std", "min", "max")


def rolling_sql(name: str, over: str, spread_digits: int = 6) -> str:
    functions = dict(zip(KINDS, ("avg", "stddev_samp", "min", "max")))
    digits = {"std": spread_digits}
    return ", ".join(
        f"round({function}({name}) OVER ({over} {FRAME}), {digits.get(kind, 6)}) AS {name}_rolling_{kind}_5m"
        for kind, function in functions.items()
    )


def rolled(name: str, spread_digits: int = 6):
    others = [f"{name}_rolling_{kind}_5m" for kind in KINDS if kind != "std"]
    return [*rounded(*others), *rounded(f"{name}_rolling_std_5m", digits=spread_digits)]


# --- windows -------------------------------------------------------------------------------


@checks.add(
    "win1_time_gap",
    f"SELECT event_id, {EPOCH} - lag({EPOCH}) OVER ({BY_USER}) AS time_since_previous_seconds FROM events",
)
def _(spark, sf_dir):
    return sequence.with_time_gap(events(spark, sf_dir), EV).select("event_id", sequence.GAP)


@checks.add(
    "win2_first_difference",
    f"SELECT event_id, round(value - lag(value) OVER ({BY_USER}), 6) AS value_delta FROM events",
)
def _(spark, sf_dir):
    return sequence.with_deltas(events(spark, sf_dir), EV).select("event_id", *rounded("value_delta"))


@checks.add("win3_rolling_rows", f"SELECT event_id, {rolling_sql('value', BY_USER)} FROM events")
def _(spark, sf_dir):
    return sequence.with_rolling(events(spark, sf_dir), EV).select("event_id", *rolled("value"))


@checks.add(
    "win3_stream_rolling",
    f"""SELECT event_id, 'accepted' AS route, {rolling_sql('value', BY_USER)} FROM events
        UNION ALL SELECT event_id, 'late', NULL, NULL, NULL, NULL FROM events
        WHERE ts < TIMESTAMP '2024-01-08 00:00:00' AND event_id % 20 = 0""",
)
def _(spark, sf_dir):
    """Four lots in time order, each a new run; the last one brings early readings once more."""
    arrived, out, state = (scratch_path(spark, label) for label in ("arrived", "rolled", "state"))
    source = events(spark, sf_dir).select("event_id", "ts", "user_id", "value")
    first = source.filter(f"ts < '{STREAM_CUTS[0]}'")
    lots = [first, *[source.filter(f"ts >= '{a}' AND ts < '{b}'") for a, b in zip(STREAM_CUTS, STREAM_CUTS[1:])]]
    lots.append(source.filter(f"ts >= '{STREAM_CUTS[-1]}'").union(first.filter("event_id % 20 = 0")))
    for lot in lots:
        lot.write.mode("append").parquet(arrived)
        stream = spark.readStream.schema(source.schema).parquet(arrived)
        run_windows(stream, EV, lambda window: sequence.rolling_expressions(window, EV.analog), sequence.ROLLING_ROWS - 1, out, state)
    return spark.read.parquet(out).select("event_id", "route", *rolled("value"))


def time_frame_sql(partition: str) -> str:
    over = f"({partition} ORDER BY epoch RANGE BETWEEN 290 PRECEDING AND CURRENT ROW)"
    return f"""SELECT event_id, round(avg(value) OVER {over}, 6) AS value_rolling_mean_5m,
                      round(stddev_samp(value) OVER {over}, 5) AS value_rolling_std_5m,
                      min(value) OVER {over} AS value_rolling_min_5m, max(value) OVER {over} AS value_rolling_max_5m
               FROM (SELECT *, {EPOCH} AS epoch FROM events)"""


def time_rolled(df):
    return df.select(
        "event_id", *rounded("value_rolling_mean_5m"), *rounded("value_rolling_std_5m", digits=5),
        "value_rolling_min_5m", "value_rolling_max_5m",
    )


@checks.add("win4_rolling_time", time_frame_sql("PARTITION BY user_id"))
def _(spark, sf_dir):
    return time_rolled(sequence.with_time_rolling(events(spark, sf_dir), EV))


@checks.add("win4_rolling_time_one_series", time_frame_sql(""))
def _(spark, sf_dir):
    return time_rolled(sequence.with_time_rolling(events(spark, sf_dir), ONE_SERIES, rows_per_range=1500))


# Every second machine stands at a level of a billion, and all drift by ten a day.
LEVELS_SQL = f"""SELECT * REPLACE (value / 100 + (user_id % 2) * 1e9::DOUBLE + {EPOCH} / 8640.0::DOUBLE AS value) FROM events"""


@checks.add(
    "win4_rolling_time_two_levels",
    f"""SELECT event_id, round(stddev_samp(value) OVER (PARTITION BY user_id ORDER BY epoch
               RANGE BETWEEN 290 PRECEDING AND CURRENT ROW), 4) AS value_rolling_std_5m
        FROM (SELECT *, {EPOCH} AS epoch FROM ({LEVELS_SQL}))""",
)
def _(spark, sf_dir):
    level = (F.col("user_id") % 2) * F.lit(1e9) + F.unix_timestamp("ts") / F.lit(8640.0)
    apart = events(spark, sf_dir).withColumn("value", F.col("value") / 100 + level)
    found = sequence.with_time_rolling(apart, EV)
    return found.select("event_id", *rounded("value_rolling_std_5m", digits=4))


CLASS_RANK_SQL = f"""SELECT event_id, fault_label,
        row_number() OVER (PARTITION BY fault_label ORDER BY md5('42:' || event_id), event_id) AS class_rank
        FROM ({LABELLED_SQL})"""


@checks.add("win5_rank_in_class", CLASS_RANK_SQL)
def _(spark, sf_dir):
    ranked = splits.with_class_rank(labelled(spark, sf_dir), "fault_label", ["event_id"])
    return ranked.select("event_id", "fault_label", "class_rank")


@checks.add(
    "win6_class_total",
    f"SELECT event_id, count(*) OVER (PARTITION BY fault_label) AS class_total FROM ({LABELLED_SQL})",
)
def _(spark, sf_dir):
    return splits.with_class_total(labelled(spark, sf_dir), "fault_label").select("event_id", "class_total")


@checks.add(
    "win7_tie_break",
    f"""SELECT {', '.join(LINE_KEY)}, epoch_us(l_shipdate) AS ship_micros,
               lag(l_orderkey) OVER (PARTITION BY l_suppkey ORDER BY {LI_ORDER}) AS previous_order FROM lineitem""",
)
def _(spark, sf_dir):
    found = ranges.with_ordered_columns(
        lineitem(spark, sf_dir),
        lambda window: {"previous_order": F.lag("l_orderkey").over(window)},
        LI.order,
        LI.machine,
    )
    return found.select(
        *LINE_KEY, F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("ship_micros"), "previous_order"
    )


@checks.add(
    "win8_one_long_series",
    f"""SELECT event_id, {EPOCH} - lag({EPOCH}) OVER (ORDER BY ts, event_id) AS time_since_previous_seconds,
               round(value - lag(value) OVER (ORDER BY ts, event_id), 6) AS value_delta,
               {rolling_sql('value', 'ORDER BY ts, event_id')} FROM events""",
)
def _(spark, sf_dir):
    found = with_features(
        events(spark, sf_dir), ONE_SERIES, gap=sequence.GAP, rows_per_range=1000
    )
    return found.select("event_id", sequence.GAP, *rounded("value_delta"), *rolled("value"))


@checks.add(
    "win8_one_long_series_with_ties",
    f"""SELECT {', '.join(LINE_KEY)}, epoch_us(l_shipdate) AS ship_micros,
               {rolling_sql('l_discount', f'ORDER BY {LI_ORDER}')} FROM lineitem""",
)
def _(spark, sf_dir):
    roles = LI.with_(machine=(), analog=("l_discount",))
    found = sequence.with_rolling(lineitem(spark, sf_dir), roles, rows_per_range=5000)
    return found.select(
        *LINE_KEY, F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("ship_micros"), *rolled("l_discount")
    )


@checks.add("win9_rank_over_ranges", CLASS_RANK_SQL)
def _(spark, sf_dir):
    ranked = splits.with_class_rank(
        labelled(spark, sf_dir), "fault_label", ["event_id"], rows_per_range=700
    )
    return ranked.select("event_id", "fault_label", "class_rank")


# --- labels --------------------------------------------------------------------------------


@checks.add("jn1_literal_windows", f"SELECT event_id, fault_label, failure_id FROM ({LABELLED_SQL})")
def _(spark, sf_dir):
    return labelled(spark, sf_dir).select("event_id", "fault_label", "failure_id")


@checks.add("jn1_window_table", f"SELECT event_id, fault_label, failure_id FROM ({LABELLED_SQL})")
def _(spark, sf_dir):
    rows = [(i, w.failure_id, w.start, w.end) for i, w in enumerate(WINDOWS)]
    windows = spark.createDataFrame(rows, "ordinal int, failure_id string, start string, end string")
    found = labeling.label_by_table(events(spark, sf_dir), windows, EV)
    return found.select("event_id", "fault_label", "failure_id")


MACHINE_WINDOWS_SQL = """
WITH w AS (SELECT user_id, event_id AS ordinal, 'E' || event_id AS failure_id, ts AS start_ts,
                  ts + INTERVAL 2 HOUR AS end_ts FROM events WHERE event_type = 'error')
SELECT e.event_id, CASE WHEN max(w.ordinal) IS NULL THEN 0 ELSE 1 END AS fault_label,
       coalesce(arg_max(w.failure_id, w.ordinal), 'NO_FAILURE') AS failure_id
FROM events e LEFT JOIN w ON e.user_id = w.user_id AND e.ts BETWEEN w.start_ts AND w.end_ts
GROUP BY e.event_id
"""


def machine_windows(spark, sf_dir):
    """Every error opens a window of two hours on its machine; many of them overlap."""
    source = events(spark, sf_dir).filter(F.col("event_type") == "error")
    return source.select(
        "user_id",
        F.col("event_id").alias("ordinal"),
        F.concat(F.lit("E"), "event_id").alias("failure_id"),
        F.col("ts").alias("start"),
        (F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("end"),
    )


@checks.add("jn1_windows_per_machine", MACHINE_WINDOWS_SQL)
def _(spark, sf_dir):
    found = labeling.label_by_table(
        events(spark, sf_dir), machine_windows(spark, sf_dir), EV, machine=["user_id"]
    )
    return found.select("event_id", "fault_label", "failure_id")


@checks.add("jn1_windows_merged_in_time_order", MACHINE_WINDOWS_SQL)
def _(spark, sf_dir):
    found = labeling.label_by_table(
        events(spark, sf_dir),
        machine_windows(spark, sf_dir),
        EV,
        machine=["user_id"],
        most_broadcast=0,
        rows_per_range=1000,
    )
    return found.select("event_id", "fault_label", "failure_id")


@checks.add("lab1_label_distribution", f"SELECT fault_label, count(*) AS row_count FROM ({LABELLED_SQL}) GROUP BY 1")
def _(spark, sf_dir):
    return labeling.label_distribution(labelled(spark, sf_dir), "fault_label")


@checks.add("lab2_failure_distribution", f"SELECT failure_id, count(*) AS row_count FROM ({LABELLED_SQL}) GROUP BY 1")
def _(spark, sf_dir):
    return labeling.label_distribution(labelled(spark, sf_dir), "failure_id")


@checks.add(
    "lab3_failure_periods",
    f"""SELECT failure_id, count(*) AS row_count, min(epoch_us(ts)) AS first_time, max(epoch_us(ts)) AS last_time
        FROM ({LABELLED_SQL}) WHERE fault_label = 1 GROUP BY 1""",
)
def _(spark, sf_dir):
    found = labeling.failure_periods(labelled(spark, sf_dir), EV)
    return found.withColumns({n: F.unix_micros(F.col(n).cast("timestamp")) for n in ("first_time", "last_time")})


@checks.add(
    "lab4_first_faults",
    f"SELECT event_id, failure_id FROM ({LABELLED_SQL}) WHERE fault_label = 1 ORDER BY ts, event_id LIMIT 20",
)
def _(spark, sf_dir):
    return labeling.first_faults(labelled(spark, sf_dir), EV).select("event_id", "failure_id")


@checks.add(
    "lab5_fault_percentage",
    f"""SELECT count(*) AS total_rows, sum(fault_label)::BIGINT AS fault_rows,
               round(sum(fault_label)::DOUBLE / count(*) * 100, 6) AS fault_percentage FROM ({LABELLED_SQL})""",
)
def _(spark, sf_dir):
    found = labeling.fault_percentage(labelled(spark, sf_dir), "fault_label")
    return found.withColumn("fault_percentage", F.round("fault_percentage", 6))


@checks.add(
    "flagship_failure_profile",
    f"""WITH f AS (
          SELECT *, {EPOCH} - lag({EPOCH}) OVER ({BY_USER}) AS gap, value - lag(value) OVER ({BY_USER}) AS delta,
                 avg(value) OVER ({BY_USER} {FRAME}) AS mean_5m, max(value) OVER ({BY_USER} {FRAME}) AS max_5m
          FROM ({LABELLED_SQL}))
        SELECT failure_id, count(*) AS row_count, count(DISTINCT user_id) AS machines,
               min({EPOCH}) AS first_epoch, max({EPOCH}) AS last_epoch, round(avg(gap), 4) AS mean_gap,
               round(avg(delta), 4) AS mean_delta, round(avg(mean_5m), 4) AS mean_rolling_mean,
               max(max_5m) AS highest FROM f GROUP BY failure_id""",
)
def _(spark, sf_dir):
    featured = with_features(labelled(spark, sf_dir), EV, gap=sequence.GAP)
    epoch = epoch_seconds(F.col("ts"))
    return featured.groupBy("failure_id").agg(
        F.count("*").alias("row_count"),
        F.count_distinct("user_id").alias("machines"),
        F.min(epoch).alias("first_epoch"),
        F.max(epoch).alias("last_epoch"),
        F.round(F.avg(sequence.GAP), 4).alias("mean_gap"),
        F.round(F.avg("value_delta"), 4).alias("mean_delta"),
        F.round(F.avg("value_rolling_mean_5m"), 4).alias("mean_rolling_mean"),
        F.max("value_rolling_max_5m").alias("highest"),
    )


@checks.add(
    "features_all",
    f"""SELECT event_id, round(value - lag(value) OVER ({BY_USER}), 6) AS value_delta, {rolling_sql('value', BY_USER)},
               hour(ts)::INTEGER AS hour, minute(ts)::INTEGER AS minute, (dayofweek(ts) + 1)::INTEGER AS day_of_week,
               round(sin(2 * pi() * hour(ts) / 24), 6) AS hour_sin, round(cos(2 * pi() * hour(ts) / 24), 6) AS hour_cos
        FROM events""",
)
def _(spark, sf_dir):
    found = with_features(events(spark, sf_dir), EV)
    return found.select(
        "event_id", *rounded("value_delta"), *rolled("value"), "hour", "minute", "day_of_week",
        *rounded("hour_sin", "hour_cos"),
    )


LINE_OVER = f"PARTITION BY l_suppkey ORDER BY {LI_ORDER}"


@checks.add(
    "features_wide_table",
    f"""SELECT {', '.join(LINE_KEY)}, epoch_us(l_shipdate) AS ship_micros,
               {', '.join(f'round({n} - lag({n}) OVER ({LINE_OVER}), 6) AS {n}_delta, {rolling_sql(n, LINE_OVER, 4)}' for n in LI.analog)}
        FROM lineitem""",
)
def _(spark, sf_dir):
    found = with_features(lineitem(spark, sf_dir), LI)
    made = [c for n in LI.analog for c in (*rounded(f"{n}_delta"), *rolled(n, spread_digits=4))]
    return found.select(*LINE_KEY, F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("ship_micros"), *made)


# --- profiles ------------------------------------------------------------------------------

FEATURES = (*WIDE, "value", "steady")


def each_feature(select: str, source: str = WIDE_LABELLED_SQL, tail: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS feature, {select.replace('$', name)} FROM ({source}) {tail}" for name in FEATURES
    )


@checks.add(
    "ana1_describe",
    each_feature(
        """count($) AS count, round(avg($), 6) AS mean, round(stddev_samp($), 6) AS stddev, min($) AS min, max($) AS max"""
    ),
)
def _(spark, sf_dir):
    found = profiling.describe_features(wide_labelled(spark, sf_dir), FEATURES)
    return found.select("feature", "count", *rounded("mean", "stddev"), "min", "max")


@checks.add(
    "ana2_means_by_label",
    f"""SELECT fault_label, {', '.join(f'round(avg({n}), 6) AS {n}_mean' for n in FEATURES)}
        FROM ({WIDE_LABELLED_SQL}) GROUP BY fault_label""",
)
def _(spark, sf_dir):
    found = profiling.means_by_label(wide_labelled(spark, sf_dir), FEATURES, "fault_label")
    return found.select("fault_label", *rounded(*[f"{n}_mean" for n in FEATURES]))


@checks.add(
    "ana3_states_by_label",
    each_feature(
        """fault_label, round(avg($), 6) AS mean, count(*) - count($) AS null_count, count($) AS non_null_count""",
        tail="GROUP BY fault_label",
    ),
)
def _(spark, sf_dir):
    found = profiling.states_by_label(wide_labelled(spark, sf_dir), FEATURES, "fault_label")
    return found.withColumn("mean", F.round("mean", 6))


@checks.add(
    "ana4_label_correlation",
    each_feature(
        """round(CASE WHEN stddev_pop($) > 0 AND stddev_pop(fault_label) FILTER ($ IS NOT NULL) > 0
                 THEN corr($, fault_label) END, 6) AS correlation"""
    ),
)
def _(spark, sf_dir):
    found = profiling.label_correlations(wide_labelled(spark, sf_dir), FEATURES, "fault_label")
    return found.withColumn("correlation", F.round("correlation", 6))


@checks.add(
    "ana4_label_correlation_null_as_zero",
    each_feature(
        """round(CASE WHEN stddev_pop(coalesce($, 0)) > 0 THEN corr(coalesce($, 0), fault_label) END, 6) AS correlation"""
    ),
)
def _(spark, sf_dir):
    found = profiling.label_correlations(
        wide_labelled(spark, sf_dir), FEATURES, "fault_label", null_as_zero=True
    )
    return found.withColumn("correlation", F.round("correlation", 6))


@checks.add(
    "ana5_constant_features",
    each_feature("count(DISTINCT $) + CASE WHEN count(*) > count($) THEN 1 ELSE 0 END <= 1 AS is_constant"),
)
def _(spark, sf_dir):
    return profiling.constant_features(wide_labelled(spark, sf_dir), FEATURES)


@checks.add(
    "ana6_missing_values",
    " UNION ALL ".join(
        f"SELECT '{n}' AS column_name, count(*) - count({n}) AS null_count FROM ({WIDE_LABELLED_SQL})" for n in FEATURES
    ),
)
def _(spark, sf_dir):
    return profiling.missing_values(wide_labelled(spark, sf_dir), FEATURES)


# --- splits and samples --------------------------------------------------------------------


@checks.add("spl1_stratified_split", f"SELECT event_id, fault_label, split FROM ({SPLIT_SQL})")
def _(spark, sf_dir):
    found = splits.stratified_split(labelled(spark, sf_dir), "fault_label", ["event_id"])
    return found.select("event_id", "fault_label", "split")


CLASSED_SQL = f"SELECT * FROM ({STRANGE_LABELS_SQL}) WHERE fault_label IN (0, 1)"


@checks.add(
    "spl1_invalid_labels",
    f"""SELECT event_id, split FROM ({SPLIT_SQL.replace(LABELLED_SQL, CLASSED_SQL)})
        UNION ALL SELECT event_id, 'rejected' FROM ({STRANGE_LABELS_SQL})
        WHERE fault_label IS NULL OR fault_label NOT IN (0, 1)""",
)
def _(spark, sf_dir):
    found = splits.stratified_split(with_strange_labels(events(spark, sf_dir)), "fault_label", ["event_id"])
    return found.select("event_id", "split")


CHRONO_SQL = f"""
WITH b AS (SELECT quantile_disc({EPOCH}, 0.70) AS first_end, quantile_disc({EPOCH}, 0.85) AS second_end FROM events)
SELECT e.*, CASE WHEN {EPOCH} <= first_end THEN 'train' WHEN {EPOCH} <= second_end THEN 'validation' ELSE 'test' END AS split
FROM ({LABELLED_SQL}) e, b
"""


@checks.add("spl2_chronological_split", f"SELECT event_id, split FROM ({CHRONO_SQL})")
def _(spark, sf_dir):
    return splits.chronological_split(events(spark, sf_dir), "ts").select("event_id", "split")


@checks.add("spl2_chronological_split_by_brackets", f"SELECT event_id, split FROM ({CHRONO_SQL})")
def _(spark, sf_dir):
    found = splits.chronological_split(events(spark, sf_dir), "ts", leaf_rows=0)
    return found.select("event_id", "split")


@checks.add(
    "spl2_chronological_split_approximate",
    "SELECT split, count(*) OVER () AS splits, true AS near_share FROM (VALUES ('train'), ('validation'), ('test')) AS t(split)",
)
def _(spark, sf_dir):
    """Every part is within a hundredth of the rows of its share."""
    found = splits.chronological_split(events(spark, sf_dir), "ts", exact=False)
    total = events(spark, sf_dir).count()
    shares = F.create_map(*[F.lit(x) for pair in (("train", 0.7), ("validation", 0.15), ("test", 0.15)) for x in pair])
    near = F.abs(F.count("*") / F.lit(total) - F.max(F.element_at(shares, F.col("split")))) <= 0.01
    return found.groupBy("split").agg(near.alias("near_share")).withColumn("splits", F.lit(3).cast("long"))


def audit_sql(source: str) -> str:
    return f"""
    SELECT split, count(*) AS row_count, count(*) FILTER (fault_label = 0) AS normal_rows,
           count(*) FILTER (fault_label = 1) AS fault_rows, min(epoch_us(ts)) AS start_time, max(epoch_us(ts)) AS end_time,
           CASE WHEN count(DISTINCT fault_label) = 2 THEN 'passed' ELSE 'warning' END AS status
    FROM ({source}) GROUP BY split"""


def audited(df):
    found = splits.split_audit(df, "fault_label", "ts")
    return found.withColumns({n: F.unix_micros(F.col(n).cast("timestamp")) for n in ("start_time", "end_time")})


@checks.add("spl3_split_audit", audit_sql(SPLIT_SQL))
def _(spark, sf_dir):
    return audited(splits.stratified_split(labelled(spark, sf_dir), "fault_label", ["event_id"]))


@checks.add("spl4_split_status", f"SELECT split, status FROM ({audit_sql(CHRONO_SQL)})")
def _(spark, sf_dir):
    return audited(splits.chronological_split(labelled(spark, sf_dir), "ts")).select("split", "status")


def leakage_sql(source: str, name: str) -> str:
    return f"""
    SELECT '{name}' AS kind, 'train_before_validation' AS check_name,
           CASE WHEN max(ts) FILTER (split = 'train') <= min(ts) FILTER (split = 'validation') THEN 'PASS' ELSE 'FAIL' END
           AS status FROM ({source})
    UNION ALL
    SELECT '{name}', 'validation_before_test',
           CASE WHEN max(ts) FILTER (split = 'validation') <= min(ts) FILTER (split = 'test') THEN 'PASS' ELSE 'FAIL' END
    FROM ({source})"""


@checks.add("spl5_leakage_check", f"{leakage_sql(CHRONO_SQL, 'time')} UNION ALL {leakage_sql(SPLIT_SQL, 'random')}")
def _(spark, sf_dir):
    source = labelled(spark, sf_dir)
    by_time = splits.leakage_check(splits.chronological_split(source, "ts"), "ts")
    at_random = splits.leakage_check(splits.stratified_split(source, "fault_label", ["event_id"]), "ts")
    return by_time.withColumn("kind", F.lit("time")).unionByName(at_random.withColumn("kind", F.lit("random")))


def sample_sql(condition: str) -> str:
    return f"""
    SELECT event_id, fault_label FROM (
      SELECT r.*, count(*) FILTER (fault_label = 1) OVER () AS p, count(*) FILTER (fault_label = 0) OVER () AS n
      FROM ({CLASS_RANK_SQL}) r) WHERE {condition}"""


@checks.add(
    "smp1_capped_sample",
    sample_sql(
        """CASE WHEN p + n <= 3000 THEN true WHEN fault_label = 1 THEN class_rank <= least(p, 1000)
           ELSE class_rank <= least(n, 3000 - least(p, 1000)) END"""
    ),
)
def _(spark, sf_dir):
    found = splits.capped_class_sample(labelled(spark, sf_dir), "fault_label", ["event_id"], max_rows=3000)
    return found.select("event_id", "fault_label")


@checks.add(
    "smp1_single_class_quota",
    """SELECT event_id FROM (
         SELECT event_id, row_number() OVER (ORDER BY md5('42:' || event_id), event_id) AS place, count(*) OVER () AS n
         FROM events) WHERE n <= 3000 OR place <= 1000""",
)
def _(spark, sf_dir):
    source = events(spark, sf_dir).withColumn("fault_label", F.lit(1))
    found = splits.capped_class_sample(source, "fault_label", ["event_id"], max_rows=3000, fill_single_class=False)
    return found.select("event_id")


@checks.add(
    "smp2_fault_preserving_sample",
    sample_sql(
        """CASE WHEN fault_label = 1 THEN class_rank <= least(p, 3000)
           ELSE class_rank <= least(n, 3000 - least(p, 3000)) END"""
    ),
)
def _(spark, sf_dir):
    found = splits.fault_preserving_sample(labelled(spark, sf_dir), "fault_label", ["event_id"], max_rows=3000)
    return found.select("event_id", "fault_label")


@checks.add(
    "smp3_seeded_order",
    "SELECT event_id, row_number() OVER (ORDER BY md5('42:' || event_id), event_id) AS place FROM events",
)
def _(spark, sf_dir):
    keyed = events(spark, sf_dir).select("event_id", seeded_digest(42, ["event_id"]).alias("digest"))
    placed = ranges.with_group_row_number(keyed, [], ["digest", "event_id"], "place", rows_per_range=2000)
    return placed.select("event_id", "place")
