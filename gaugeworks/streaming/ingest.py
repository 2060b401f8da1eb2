"""Incremental form of the ingest and of the row checks.

The row operators apply to a stream unchanged.  The checkpoint of the file
source remembers which files were read, the ingest log which contents landed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.columns import ref
from gaugeworks.operators.batch_reports import BATCH, BatchReports
from gaugeworks.operators.contracts import ContractError
from gaugeworks.operators.quality import ACCEPTED, missing_time_rule, with_verdict
from gaugeworks.sources.files import CORRUPT, FILE, TIME_PATTERN, file_of_row, hashed_files, in_header_order, list_files, read_headers
from gaugeworks.sources.landing import Landing
from gaugeworks.sources.scratch import written


def stream_csv(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """CSV files as they arrive, columns bound by the header of the files that are there at the start.

    A later file whose header has other names or another order ends the batch
    instead of swapping columns.
    """
    headers = read_headers(list_files(spark, path).select("path", "length")).select("header").distinct().take(2)
    if len(headers) > 1:
        raise ContractError(f"files with different headers under {path}")
    header = list(headers[0]["header"]) if headers else schema.names
    bound = in_header_order(header, schema).fields
    named = [T.StructField(name, field.dataType) for name, field in zip(header, bound)]
    reader = (
        spark.readStream.option("header", True)
        .option("timestampFormat", TIME_PATTERN)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", False)
        .schema(T.StructType([*named, T.StructField(CORRUPT, T.StringType())]))
    )
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    place = {field.name: name for name, field in zip(header, bound)}
    return reader.csv(path).select(*[ref(place[name]).alias(name) for name in schema.names], CORRUPT)


def with_stream_lineage(df: DataFrame, machine_id: str) -> DataFrame:
    return df.withColumns(
        {
            "machine_id": F.lit(machine_id),
            "_source_file": F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1),
            "_ingested_at": F.current_timestamp(),
        }
    )


def run_landing(df: DataFrame, store: Landing, machine_id: str, checkpoint: str, name: str = "stream") -> None:
    """Land the files that have arrived since the last run, each content once per machine.

    The files of a batch are hashed by tasks and compared with the ingest log
    inside the batch, so a copy under another name does not land, whether it
    comes in the same batch, a later one, or beside a batch ingest.  The run of
    a batch is its number: a batch that is replayed after a failure, before or
    after its log entries, ignores its own entries and replaces its own rows.
    """

    def land(batch: DataFrame, number: int) -> None:
        run_id = f"{name}-{number}"
        arrived = batch.select(F.col(FILE).alias("path"), F.col("__modified").alias("modificationTime")).distinct()
        fresh = written(store.fresh_files(hashed_files(arrived), machine_id, run_id), "fresh-files")
        if not fresh.isEmpty():
            store.land(batch.drop("__modified"), fresh, machine_id, run_id)

    located = df.withColumns({FILE: file_of_row(), "__modified": F.col("_metadata.file_modification_time")})
    query = (
        located.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_available(df: DataFrame, path: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Append everything that has arrived since the last run, then stop."""
    target = transform(df) if transform else df
    query = (
        target.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_reported(df: DataFrame, path: str, reports: BatchReports, checkpoint: str) -> None:
    """Land the readings of a stream in ``path/batch=<number>`` and add each batch to ``reports``.

    A replayed batch replaces its rows and its part of the reports.
    """

    def land(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")
        reports.add(batch.sparkSession.read.parquet(path), number)

    query = (
        df.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_quarantine(df: DataFrame, rules: dict[str, Column], path: str, checkpoint: str) -> None:
    """Judge the readings of a stream; accepted and rejected ones land in separate folders.

    Each batch is written once, under its own number with overwrite, so a
    replayed batch replaces itself.  Readers filter on ``route``.
    """

    def write(batch: DataFrame, number: int) -> None:
        judged = with_verdict(batch, rules)
        judged.write.mode("overwrite").partitionBy("route").parquet(f"{path}/batch={number}")

    query = (
        df.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


LATE = "late"


def run_unique(
    df: DataFrame,
    time: str,
    keys: Sequence[str],
    path: str,
    checkpoint: str,
    lateness_seconds: int,
    rules: dict[str, Column] | None = None,
) -> None:
    """Readings of a stream without copies, in ``path`` with a ``route``: accepted, rejected or late.

    A reading is a copy if an accepted one has the same ``keys`` (nulls are
    equal), in the same batch or an earlier one.  Readings more than
    ``lateness_seconds`` older than the newest of earlier batches are routed to
    ``late`` instead of being lost, so a batch is compared only with what has
    been accepted since then: the work of a batch is bounded by that horizon,
    however long the table grows.  Readings that a rule rejects, a missing time
    among them, keep their reasons and take no part.

    What a stateful operator would keep in memory is the table itself and one
    mark per batch.  Each batch is written under its number and looks only at
    smaller ones, so a replayed batch replaces itself.
    """
    checked = {**missing_time_rule(time), **(rules or {})}
    marks = f"{path.rstrip('/')}_marks"

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        judged = with_verdict(batch, checked)
        newest = _earlier(spark, marks, "newest timestamp", number).agg(F.max("newest").alias("newest"))
        seen = newest.first()["newest"]
        since = None if seen is None else seen - timedelta(seconds=lateness_seconds)
        moment = ref(time).cast("timestamp")
        if since is not None:
            late = (F.col("route") == ACCEPTED) & (moment < F.lit(since))
            judged = judged.withColumn("route", F.when(late, LATE).otherwise(F.col("route")))
        fresh = judged.filter(F.col("route") == ACCEPTED).dropDuplicates(list(keys))
        if since is not None:
            known = _earlier(spark, path, judged.schema, number).filter((F.col("route") == ACCEPTED) & (moment >= F.lit(since)))
            known = known.select(*[ref(name).alias(f"__k{i}") for i, name in enumerate(keys)])
            same = reduce(and_, [ref(name).eqNullSafe(F.col(f"__k{i}")) for i, name in enumerate(keys)])
            fresh = fresh.join(known, same, "left_anti")
        routed = fresh.unionByName(judged.filter(F.col("route") != ACCEPTED))
        routed.write.mode("overwrite").partitionBy("route").parquet(f"{path}/batch={number}")
        arrived = batch.agg(F.max(moment).alias("newest"))
        arrived.write.mode("overwrite").parquet(f"{marks}/batch={number}")

    query = (
        df.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _earlier(spark: SparkSession, path: str, schema: T.StructType | str, number: int) -> DataFrame:
    """What batches before this one have written; nothing if there is none."""
    kinds = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    full = T.StructType([*kinds.fields, T.StructField("batch", T.LongType())])
    try:
        return spark.read.schema(full).parquet(path).filter(F.col("batch") < number)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], full)
        raise
