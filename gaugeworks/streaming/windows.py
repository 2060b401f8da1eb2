"""Lag and rolling columns on a stream of readings.

What a keyed state would hold is a small table per batch: the last readings of
every machine, and readings that still wait for earlier ones.  A batch runs the
batch operators over those and the new readings, so a machine that sends a
third of all rows is spread over ranges instead of meeting in one state.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.columns import ref, refs
from gaugeworks.operators.quality import ACCEPTED, REJECTED
from gaugeworks.operators.ranges import DEFAULT_ROWS_PER_RANGE
from gaugeworks.operators.sequence import with_window_columns
from gaugeworks.roles import SeriesRoles
from gaugeworks.sources.scratch import drop_written, written
from gaugeworks.streaming.ingest import LATE

#: In the state: already answered, kept for the frames of later readings.
DONE = "__done"


def run_windows(
    df: DataFrame,
    roles: SeriesRoles,
    build: Callable[[WindowSpec], dict[str, Column]],
    lookback: int,
    path: str,
    checkpoint: str,
    delay_seconds: int = 0,
    rows_per_range: int = DEFAULT_ROWS_PER_RANGE,
) -> None:
    """Window columns for everything that has arrived since the last run, in ``path`` with a ``route``.

    ``build`` is the function a batch window takes; its frames look back at
    most ``lookback`` rows.  A reading is answered once the newest reading is
    ``delay_seconds`` younger, so readings may arrive in any order within that
    delay; until then ``waiting`` shows it.  Accepted rows equal those of the
    batch operator over all accepted readings.  A reading that does not follow
    the last answered one of its machine would change answers already given:
    it goes to ``late``, one without a time to ``rejected``, both without
    window columns.  ``roles.seq`` must be named, as the order has to be total
    over batches; a copy of an answered reading does not follow it.

    Each batch writes its rows and its state under its number and reads only
    the state before it, so a replayed batch replaces itself.  States older
    than that are deleted.
    """
    if not roles.seq:
        raise ValueError("windows on a stream need a tie-break column")
    order = list(roles.order)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        arrived = written(batch.withColumn(DONE, F.lit(False)), "arrived")
        held = _state(spark, path, arrived.schema, number - 1)
        timed, untimed = arrived.filter(ref(roles.time).isNotNull()), arrived.filter(ref(roles.time).isNull())
        late, following = _after_the_answered(timed, held, roles)

        known = written(held.unionByName(following), "known")
        ready, newest = F.col(DONE), known.agg(F.max(ref(roles.time))).first()[0]
        if newest is not None:
            ready = ready | (ref(roles.time) <= F.lit(newest - timedelta(seconds=delay_seconds)))
        answered = with_window_columns(known.filter(ready), roles, build, lookback, rows_per_range).filter(~F.col(DONE))
        routed = answered.withColumn("route", F.lit(ACCEPTED))
        for part, route in ((late, LATE), (untimed, REJECTED)):
            routed = routed.unionByName(part.withColumn("route", F.lit(route)), allowMissingColumns=True)
        routed.drop(DONE).write.mode("overwrite").partitionBy("route").parquet(f"{path}/batch={number}")

        # Each task keeps no more than the last rows of a machine before they are shuffled.
        backwards = Window.partitionBy(*refs(roles.machine)).orderBy(*[ref(name).desc() for name in order])
        tail = known.filter(ready).withColumn("__back", F.row_number().over(backwards)).filter(F.col("__back") <= max(1, lookback))
        state = tail.drop("__back").withColumn(DONE, F.lit(True)).unionByName(known.filter(~ready))
        state.write.mode("overwrite").parquet(_state_path(path, number))
        for table in (arrived, known):
            drop_written(table)
        _delete(spark, _state_path(path, number - 2))

    query = (
        df.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def waiting(spark: SparkSession, path: str, schema: T.StructType, number: int) -> DataFrame:
    """Readings that batch ``number`` could not answer yet."""
    return _state(spark, path, T.StructType([*schema.fields, T.StructField(DONE, T.BooleanType())]), number).filter(~F.col(DONE)).drop(DONE)


def _after_the_answered(timed: DataFrame, held: DataFrame, roles: SeriesRoles) -> tuple[DataFrame, DataFrame]:
    """Readings before, and after, the last answered one of their machine; null machines are one machine."""
    machine = [f"__m{i}" for i in range(len(roles.machine))]
    place = F.struct(*refs(roles.order))
    last = held.filter(DONE).groupBy(*[ref(name).alias(label) for name, label in zip(roles.machine, machine)]).agg(F.max(place).alias("__last"))
    same = reduce(and_, [ref(name).eqNullSafe(F.col(label)) for name, label in zip(roles.machine, machine)], F.lit(True))
    beside = timed.join(last, same, "left")
    follows = F.col("__last").isNull() | (place > F.col("__last"))
    own = refs(timed.columns)
    return beside.filter(~follows).select(*own), beside.filter(follows).select(*own)


def _state_path(path: str, number: int) -> str:
    return f"{path.rstrip('/')}_state/batch={number}"


def _state(spark: SparkSession, path: str, schema: T.StructType, number: int) -> DataFrame:
    if number < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(_state_path(path, number))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
