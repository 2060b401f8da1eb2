"""Reports from partial rows of batches against the reports over the whole table."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import quality
from gaugeworks.operators.batch_reports import BatchReports
from gaugeworks.streaming.ingest import run_reported

SCHEMA = "seq long, at timestamp, total string, value double, batch int"


def readings(spark, batches):
    """Copies inside and across batches, nulls, and one time that most rows hold."""
    draw, rows = random.Random(4), []
    for number, size in batches:
        for _ in range(size):
            seq = draw.choice([None, *range(200)])
            second = draw.choice([None, 7, 7, 7, draw.randrange(500)])
            rows.append((seq, second, "x", draw.choice([None, 1.0]), number))
    frame = spark.createDataFrame(rows, "seq long, second long, total string, value double, batch int")
    return frame.withColumn("at", F.timestamp_seconds("second")).select("seq", "at", "total", "value", "batch")


def metrics(report):
    return {(r.metric_name, r.metric_value, r.status, r.run_id) for r in report.collect()}


def assert_whole(reports, df):
    whole = df.drop("batch")
    assert metrics(reports.quality_report("r")) == metrics(quality.quality_report(whole, "at", "seq", "r"))
    found = reports.index_statistics()
    assert found.drop("estimated_indexes").collect() == quality.index_statistics(whole, "seq").collect()
    got = found.first()
    assert abs(got["estimated_indexes"] - got["distinct_indexes"]) <= 0.05 * got["distinct_indexes"]


def test_batches_equal_the_whole(spark, tmp_path):
    df = readings(spark, [(0, 300), (1, 0), (2, 250), (5, 400)]).cache()
    reports = BatchReports(spark, str(tmp_path / "r"), "at", "seq")
    for number in (0, 1, 2, 5):
        reports.add(df, number)
        assert_whole(reports, df.filter(F.col("batch") <= number))
    for number in (2, 5, 0):
        reports.add(df, number)
        assert_whole(reports, df)


def test_nulls_only_and_nothing(spark, tmp_path):
    df = spark.createDataFrame([(None, None, "x", None, 0), (None, None, "x", None, 0)], SCHEMA)
    reports = BatchReports(spark, str(tmp_path / "r"), "at", "seq")
    with pytest.raises(ValueError, match="no batch"):
        reports.partials()
    reports.add(df, 0)
    assert metrics(reports.quality_report("r")) == metrics(quality.quality_report(df.drop("batch"), "at", "seq", "r"))
    empty = BatchReports(spark, str(tmp_path / "e"), "at")
    empty.add(df.limit(0), 0)
    assert metrics(empty.quality_report("r")) == metrics(quality.quality_report(df.drop("batch").limit(0), "at", None, "r"))


def test_numbers_must_grow(spark, tmp_path):
    df = readings(spark, [(0, 5), (1, 5)])
    reports = BatchReports(spark, str(tmp_path / "r"), "at", "seq")
    reports.add(df, 1)
    with pytest.raises(ValueError, match="batch 0 after batch 1"):
        reports.add(df, 0)


def test_earlier_batches_are_not_read_when_later_in_time(spark, tmp_path):
    df = spark.range(60).select(
        F.col("id").alias("seq"),
        F.timestamp_seconds("id").alias("at"),
        F.lit("x").alias("total"),
        F.lit(1.0).alias("value"),
        F.floor(F.col("id") / 20).cast("int").alias("batch"),
    )
    reports = BatchReports(spark, str(tmp_path / "r"), "at", "seq")
    for number in range(3):
        fails = F.when(F.col("batch") < number, F.raise_error(F.lit("an earlier batch was read")).cast("long"))
        reports.add(df.withColumn("seq", F.coalesce(fails, "seq")), number)
    assert_whole(reports, df)


def test_stream_with_restart(spark, tmp_path):
    reports = BatchReports(spark, str(tmp_path / "r"), "at", "seq")
    source = readings(spark, [(0, 120), (1, 150), (2, 90)]).cache()
    for number in range(3):
        source.filter(F.col("batch") == number).drop("batch").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(source.drop("batch").schema).parquet(str(tmp_path / "in"))
        run_reported(stream, str(tmp_path / "out"), reports, str(tmp_path / "state"))
        assert_whole(reports, source.filter(F.col("batch") <= number))
    assert reports.partials().count() == 3
