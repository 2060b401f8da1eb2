"""What the checks share: fixtures in Spark and the same fixtures in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.operators.labeling import FaultWindow, label_by_windows
from gaugeworks.roles import SeriesRoles

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    query: Query
    sql: str | None = None


class Registry(dict[str, Check]):
    def add(self, name: str, sql: str | None = None):
        def register(query: Query) -> Query:
            if name in self:
                raise KeyError(f"duplicate check {name}")
            self[name] = Check(query, sql)
            return query

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- events as a narrow sensor series -------------------------------------------------

EV = SeriesRoles(
    time="ts",
    seq=("event_id",),
    machine=("user_id",),
    analog=("value",),
    flags=("event_type",),
)
# The same readings as one global series.
ONE_SERIES = EV.with_(machine=())

WINDOWS = (
    FaultWindow("F1", "2024-01-05 00:00:00", "2024-01-05 23:59:59"),
    FaultWindow("F2", "2024-01-11 23:30:00", "2024-01-12 06:00:00"),
    FaultWindow("F3", "2024-01-17 10:00:00", "2024-01-19 14:30:00"),
    FaultWindow("F4", "2024-01-24 14:30:00", "2024-01-24 19:00:00"),
    FaultWindow("F5", "2024-01-19 12:00:00", "2024-01-19 18:00:00"),
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_by_windows(events(spark, sf_dir), EV, WINDOWS)


FAILURE_CASE = (
    "CASE "
    + " ".join(
        f"WHEN ts BETWEEN TIMESTAMP '{w.start}' AND TIMESTAMP '{w.end}' THEN '{w.failure_id}'"
        for w in reversed(WINDOWS)
    )
    + " ELSE 'NO_FAILURE' END"
)
LABELLED_SQL = f"""
SELECT *, CASE WHEN failure_id = 'NO_FAILURE' THEN 0 ELSE 1 END AS fault_label
FROM (SELECT *, {FAILURE_CASE} AS failure_id FROM events)
"""

# Defects injected into the whole table, by the same rule on both sides.


def with_null_times(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.when(F.col("event_id") % 97 != 0, F.col("ts")))


NULL_TIMES_SQL = "SELECT * REPLACE (CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END AS ts) FROM events"


def with_null_values(df: DataFrame) -> DataFrame:
    return df.withColumn("value", F.when(F.col("event_id") % 13 != 0, F.col("value")))


def with_repeats(df: DataFrame) -> DataFrame:
    """Every error is recorded twice."""
    return df.unionByName(df.filter(F.col("event_type") == "error"))


REPEATS_SQL = "SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_type = 'error'"


def with_strange_values(df: DataFrame) -> DataFrame:
    strange = (
        F.when(F.col("event_id") % 101 == 0, F.lit(float("inf")))
        .when(F.col("event_id") % 103 == 0, F.lit(float("nan")))
        .when(F.col("event_id") % 107 == 0, F.lit(None))
        .otherwise(F.col("value"))
    )
    return df.withColumn("value", strange)


STRANGE_SQL = """
SELECT * REPLACE (CASE WHEN event_id % 101 = 0 THEN 'Infinity'::DOUBLE
                       WHEN event_id % 103 = 0 THEN 'NaN'::DOUBLE
                       WHEN event_id % 107 = 0 THEN NULL ELSE value END AS value) FROM events
"""


def with_strange_labels(df: DataFrame) -> DataFrame:
    strange = (
        F.when(F.col("event_id") % 211 == 0, F.lit(2))
        .when(F.col("event_id") % 223 == 0, F.lit(None))
        .otherwise((F.col("event_type") == "error").cast("int"))
    )
    return df.withColumn("fault_label", strange)


STRANGE_LABELS_SQL = """
SELECT *, CASE WHEN event_id % 211 = 0 THEN 2 WHEN event_id % 223 = 0 THEN NULL
               WHEN event_type = 'error' THEN 1 ELSE 0 END AS fault_label FROM events
"""

SPLIT_SQL = f"""
SELECT *, CASE WHEN rank <= train_end THEN 'train' WHEN rank <= validation_end THEN 'validation' ELSE 'test' END AS split
FROM (
  SELECT *, least(greatest(train_end + 1, CAST(floor(total * CAST(0.85 AS DOUBLE)) AS BIGINT)), total - 1) AS validation_end
  FROM (
    SELECT *, least(greatest(1, CAST(floor(total * CAST(0.70 AS DOUBLE)) AS BIGINT)), total - 2) AS train_end
    FROM (
      SELECT *, row_number() OVER (PARTITION BY fault_label ORDER BY md5('42:' || event_id), event_id) AS rank,
             count(*) OVER (PARTITION BY fault_label) AS total
      FROM ({LABELLED_SQL}))))
"""

# --- events with one sensor column per event type --------------------------------------

KINDS = ("click", "error", "purchase", "signup", "view")
WIDE = tuple(f"{kind}_value" for kind in KINDS)


def wide(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {name: F.when(F.col("event_type") == kind, F.col("value")) for name, kind in zip(WIDE, KINDS)}
    )


WIDE_COLUMNS = ", ".join(
    f"CASE WHEN event_type = '{kind}' THEN value END AS {name}" for name, kind in zip(WIDE, KINDS)
)
WIDE_LABELLED_SQL = f"SELECT *, {WIDE_COLUMNS}, 1.0::DOUBLE AS steady FROM ({LABELLED_SQL})"


def wide_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide(labelled(spark, sf_dir)).withColumn("steady", F.lit(1.0))


# --- lineitem as a wide series with many readings per day -------------------------------

LINE_KEY = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
)
LI = SeriesRoles(
    time="l_shipdate",
    seq=LINE_KEY,
    machine=("l_suppkey",),
    analog=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    flags=("l_returnflag", "l_linestatus"),
)
LI_ORDER = "l_shipdate, " + ", ".join(LINE_KEY)


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


# --- deterministic scores of two models -------------------------------------------------


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long scores: model a follows the value, model b repeats a thousand scores."""
    source = events(spark, sf_dir).select(
        "event_id",
        (F.col("event_type") == "error").cast("int").alias("label"),
        F.least(F.col("value") / 500.0, F.lit(1.0)).alias("a"),
        ((F.col("event_id") * 7919 % 1000) / 1000.0).alias("b"),
    )
    return source.select(
        "event_id", "label", F.inline(F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("probability")) for m in "ab"]))
    )


def one_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(spark, sf_dir).filter(F.col("model") == "a").drop("model")


SCORES_SQL = """
SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label, 'a' AS model,
       least(value / 500.0::DOUBLE, 1.0::DOUBLE) AS probability FROM events
UNION ALL
SELECT event_id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END, 'b',
       (event_id * 7919 % 1000) / 1000.0::DOUBLE FROM events
"""
ONE_MODEL_SQL = f"SELECT * EXCLUDE (model) FROM ({SCORES_SQL}) WHERE model = 'a'"


def rounded(*names: str, digits: int = 6):
    return [F.round(F.col(name), digits).alias(name) for name in names]
