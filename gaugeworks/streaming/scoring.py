"""Scoring of a stream.  Scoring keeps no state, so the batch model applies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.quality import ACCEPTED, REJECTED
from gaugeworks.operators.training import FaultModel, score_with_contract


def score_stream(readings: DataFrame, model: FaultModel, path: str, checkpoint: str, threshold: float = 0.5) -> None:
    """Score everything that has arrived since the last run and append it to ``path``.

    Readings that cannot be scored go to the same table, in ``route=rejected``,
    without a score; none is dropped.  A batch is one write under its number,
    so both routes are committed together and a replayed batch replaces itself.
    """

    def write(batch: DataFrame, number: int) -> None:
        scored, rejected = score_with_contract(batch, model, threshold)
        routed = scored.withColumn("route", F.lit(ACCEPTED)).unionByName(rejected.withColumn("route", F.lit(REJECTED)), allowMissingColumns=True)
        routed.write.mode("overwrite").partitionBy("route").parquet(f"{path}/batch={number}")

    query = (
        readings.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
