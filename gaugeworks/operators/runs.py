"""State of stage runs, kept as rows of an event table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.columns import ref, refs
from gaugeworks.operators.ranges import DEFAULT_ROWS_PER_RANGE, with_ordered_columns

# Events a stage writes.
STARTED, COMPLETED, FAILED = "Starting", "Completed", "Failed"


def latest_status(
    log: DataFrame, keys: Sequence[str], updated_at: str, values: Sequence[str], tie: Sequence[str] = ()
) -> DataFrame:
    """Last written values per key; an aggregate, so a busy key never fills one task."""
    order = F.struct(*refs([updated_at, *tie]))
    latest = F.max_by(F.struct(*refs([updated_at, *values])), order)
    return log.groupBy(*refs(keys)).agg(latest.alias("__latest")).select(*refs(keys), "__latest.*")


def stage_durations(
    log: DataFrame,
    run: str,
    stage: str,
    event: str,
    time: str,
    tie: Sequence[str] = (),
    started: Sequence[str] = (STARTED,),
    finished: Sequence[str] = (COMPLETED, FAILED),
    rows_per_range: int = DEFAULT_ROWS_PER_RANGE,
) -> DataFrame:
    """Seconds from each start of a stage to the event after it, when that one ends the stage."""
    relevant = log.filter(ref(event).isin(*started, *finished))

    def build(window) -> dict:
        return {
            "__previous": F.lag(ref(event)).over(window),
            "started_at": F.lag(ref(time)).over(window),
        }

    ordered = with_ordered_columns(
        relevant, build, [time, *tie], [run, stage], lookback=1, rows_per_range=rows_per_range
    )
    paired = ordered.filter(ref(event).isin(*finished) & F.col("__previous").isin(*started))
    seconds = (F.unix_micros(ref(time).cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))) / 1e6
    return paired.select(
        *refs([run, stage]),
        "started_at",
        ref(time).alias("finished_at"),
        ref(event).alias("outcome"),
        seconds.alias("seconds"),
    )


def with_resume_decision(
    current: DataFrame, log: DataFrame, keys: Sequence[str], mode: str, fingerprint: str
) -> DataFrame:
    """Each current input with the decision to reuse a recorded stage or to run it.

    A stage is reused only when mode and fingerprint equal recorded ones; each
    input meets at most one distinct record.
    """
    match = [*keys, mode, fingerprint]
    recorded = log.select(*refs(match)).distinct().withColumn("reuse", F.lit(True))
    return current.join(recorded, match, "left").withColumn("reuse", F.coalesce("reuse", F.lit(False)))
