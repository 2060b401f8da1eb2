"""Fault labels from a list or a table of time windows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.functions.columns import epoch_seconds, instant, ratio, ref, refs
from gaugeworks.operators.ranges import (
    DEFAULT_ROWS_PER_RANGE,
    RANGE,
    TIE,
    OrderedRanges,
    from_earlier_ranges,
    join_range_offsets,
    with_group_row_number,
    with_tie_break,
)
from gaugeworks.roles import SeriesRoles
from gaugeworks.sources.scratch import written

NO_FAILURE = "NO_FAILURE"
# More literal windows than this and a lookup table is the better plan.
MOST_LITERAL_WINDOWS = 64
# Segments that may be broadcast: a few ten bytes each.
MOST_BROADCAST_SEGMENTS = 500_000
# Widths of the time slices readings and segments meet in, in seconds.
SLICE_WIDTHS = (1, 60, 3_600, 86_400)


@dataclass(frozen=True)
class FaultWindow:
    """Closed interval; on overlap the later window in a list wins."""

    failure_id: str
    start: str
    end: str


# Documented failures of the air-compressor record.
COMPRESSOR_FAILURES = (
    FaultWindow("F1", "2020-04-18 00:00:00", "2020-04-18 23:59:59"),
    FaultWindow("F2", "2020-05-29 23:30:00", "2020-05-30 06:00:00"),
    FaultWindow("F3", "2020-06-05 10:00:00", "2020-06-07 14:30:00"),
    FaultWindow("F4", "2020-07-15 14:30:00", "2020-07-15 19:00:00"),
)


def in_window(df: DataFrame, time: str, window: FaultWindow) -> Column:
    return ref(time).between(instant(df, time, window.start), instant(df, time, window.end))


def label_by_windows(df: DataFrame, roles: SeriesRoles, windows: Sequence[FaultWindow]) -> DataFrame:
    """Label and failure id from a list of windows: a projection; a long list becomes a table of windows."""
    if len(windows) > MOST_LITERAL_WINDOWS:
        listed = df.sparkSession.createDataFrame(
            [(w.failure_id, w.start, w.end, place) for place, w in enumerate(windows)],
            "failure_id string, start string, end string, ordinal int",
        )
        return label_by_table(df, listed, roles)
    latest = F.lit(None).cast("string")
    for window in windows:
        latest = F.when(in_window(df, roles.time, window), F.lit(window.failure_id)).otherwise(latest)
    return _finish(df.withColumn(roles.failure_id, latest), roles)


def _finish(df: DataFrame, roles: SeriesRoles) -> DataFrame:
    failure = ref(roles.failure_id)
    return df.withColumns(
        {
            roles.label: failure.isNotNull().cast("int"),
            roles.failure_id: F.coalesce(failure, F.lit(NO_FAILURE)),
        }
    )


def disjoint_segments(
    windows: DataFrame,
    time_type: str,
    machine: Sequence[str] = (),
    rows_per_range: int = DEFAULT_ROWS_PER_RANGE,
) -> DataFrame:
    """Cut overlapping windows at every start and end and settle who wins in between.

    ``windows`` has ``ordinal, failure_id, start, end`` and the machine columns;
    the result ``machine, start, stop, failure_id`` covers all time between the
    first and the last cut: ``failure_id`` is null where no window is open and
    ``stop`` is null after the last one.

    A window is spread over the few nodes of a binary tree above the segments
    that make it up, and a segment looks at the nodes above it.  The work grows
    with n log n even where all windows overlap.
    """
    closed = windows.select(
        *refs(machine),
        "ordinal",
        "failure_id",
        F.col("start").cast(time_type).alias("start"),
        (F.col("end").cast(time_type) + F.expr("INTERVAL '0.000001' SECOND")).alias("stop"),
    ).filter(F.col("start") < F.col("stop"))
    for name in machine:
        closed = closed.filter(ref(name).isNotNull())
    cuts = (
        closed.select(*refs(machine), F.col("start").alias("cut"))
        .unionByName(closed.select(*refs(machine), F.col("stop").alias("cut")))
        .distinct()
    )
    cuts = written(with_group_row_number(cuts, machine, ["cut"], "place", rows_per_range), "cuts")
    levels = max(1, cuts.count().bit_length())
    following = cuts.select(*refs(machine), (F.col("place") - 1).alias("place"), F.col("cut").alias("stop"))
    segments = cuts.withColumnRenamed("cut", "start").join(following, [*machine, "place"], "left")

    def placed(column: str, name: str) -> DataFrame:
        return cuts.select(*refs(machine), F.col("cut").alias(column), F.col("place").alias(name))

    every_level = F.sequence(F.lit(0), F.lit(levels))
    width = F.expr("shiftleft(1L, level)")
    spans = (
        closed.join(placed("start", "first"), [*machine, "start"])
        .join(placed("stop", "last"), [*machine, "stop"])
        .select(*refs(machine), "ordinal", "failure_id", "first", "last", F.explode(every_level).alias("level"))
    )
    low = F.floor((F.col("first") + width - 1) / width)
    high = F.floor(F.col("last") / width)
    nodes = spans.withColumns({"low": low, "high": high}).filter(F.col("low") < F.col("high"))
    ends = F.array(
        F.when(F.col("low") % 2 == 1, F.col("low")), F.when(F.col("high") % 2 == 1, F.col("high") - 1)
    )
    winners = (
        nodes.select(*refs(machine), "level", "ordinal", "failure_id", F.explode(F.array_compact(ends)).alias("node"))
        .groupBy(*refs(machine), "level", "node")
        .agg(F.max(F.struct("ordinal", "failure_id")).alias("winner"))
    )
    above = segments.filter(F.col("stop").isNotNull()).select(
        *refs(machine), "place", F.explode(every_level).alias("level")
    )
    above = above.withColumn("node", F.floor(F.col("place") / width))
    decided = (
        above.join(winners, [*machine, "level", "node"])
        .groupBy(*refs(machine), "place")
        .agg(F.max("winner").alias("winner"))
        .select(*refs(machine), "place", F.col("winner.failure_id").alias("failure_id"))
    )
    return segments.join(decided, [*machine, "place"], "left").select(
        *refs(machine), "start", "stop", "failure_id"
    )


def _slice(column: str, seconds: int) -> Column:
    return F.floor(epoch_seconds(ref(column)) / seconds)


def label_by_table(
    df: DataFrame,
    windows: DataFrame,
    roles: SeriesRoles,
    machine: Sequence[str] = (),
    most_broadcast: int = MOST_BROADCAST_SEGMENTS,
    rows_per_range: int = DEFAULT_ROWS_PER_RANGE,
) -> DataFrame:
    """Label from a table of any number of windows, globally or per machine.

    Overlaps are settled among the windows first, so a reading lies in at most
    one segment and is never multiplied.  A counted, small set of segments is
    broadcast; a larger one is merged with the readings in time order.
    """
    time_type = df.schema[roles.time].dataType.simpleString()
    segments = written(disjoint_segments(windows, time_type, machine, rows_per_range), "segments")
    sliced = _by_length(segments.filter(F.col("failure_id").isNotNull()))
    sizes = {row["width"]: row["count"] for row in sliced.groupBy("width").count().collect()}
    if sum(sizes.values()) <= most_broadcast:
        labelled = _look_up(df, sliced, sorted(sizes), roles, machine)
    else:
        labelled = _merge(df, segments, roles, machine, rows_per_range)
    return _finish(labelled, roles)


def _by_length(segments: DataFrame) -> DataFrame:
    """Each segment under the time slices it touches, in slices about as wide as it is long.

    Segments are disjoint, so a slice holds some sixty of them at most and a
    segment touches two slices, or one for each of its days.
    """
    length = epoch_seconds(F.col("stop")) - epoch_seconds(F.col("start"))
    width = F.lit(SLICE_WIDTHS[-1])
    for seconds in reversed(SLICE_WIDTHS[:-1]):
        width = F.when(length <= seconds, seconds).otherwise(width)
    sized = segments.withColumn("width", width)
    first = F.floor(epoch_seconds(F.col("start")) / F.col("width"))
    last = F.floor(epoch_seconds(F.col("stop")) / F.col("width"))
    return sized.withColumn("slice", F.explode(F.sequence(first, last)))


def _look_up(
    df: DataFrame, sliced: DataFrame, widths: Sequence[int], roles: SeriesRoles, machine: Sequence[str]
) -> DataFrame:
    """Broadcast joins on machine and slice, one per slice width, the interval as residual condition."""
    found, labelled = [], df
    for width in widths:
        right = sliced.filter(F.col("width") == width).select(
            *[ref(name).alias(f"__{name}") for name in (*machine, "slice", "start", "stop", "failure_id")]
        )
        meets = (
            (_slice(roles.time, width) == F.col("__slice"))
            & (ref(roles.time) >= F.col("__start"))
            & (ref(roles.time) < F.col("__stop"))
        )
        for name in machine:
            meets = meets & (ref(name) == ref(f"__{name}"))
        labelled = (
            labelled.join(F.broadcast(right), meets, "left")
            .drop(*[f"__{name}" for name in (*machine, "slice", "start", "stop")])
            .withColumnRenamed("__failure_id", f"__found_{width}")
        )
        found.append(f"__found_{width}")
    latest = F.coalesce(*[F.col(name) for name in found]) if found else F.lit(None).cast("string")
    return labelled.withColumn(roles.failure_id, latest).drop(*found)


def _merge(
    df: DataFrame, segments: DataFrame, roles: SeriesRoles, machine: Sequence[str], rows_per_range: int
) -> DataFrame:
    """Readings and segment starts in one time order; each reading takes the last start before it.

    The order is cut into balanced ranges, so neither a busy machine nor a busy
    instant fills a task; what is open at the start of a range is carried in.
    """
    starts = segments.select(
        *refs(machine),
        F.col("start").alias(roles.time),
        F.lit(0).alias("__kind"),
        F.struct(F.col("start").alias("since"), F.col("failure_id")).alias("__open"),
    )
    tied, (_, *ties) = with_tie_break(df, roles.time, roles.seq)
    both = tied.withColumn("__kind", F.lit(1)).unionByName(starts, allowMissingColumns=True)
    order = (roles.time, "__kind", *ties)
    ranges = OrderedRanges.plan(both, (*machine, *order), rows_per_range)
    tagged = both.withColumn(RANGE, ranges.range_id)
    window = Window.partitionBy(RANGE, *refs(machine)).orderBy(*refs(order))
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = tagged.withColumn("__last", F.last("__open", ignorenulls=True).over(upto))
    if ranges.count > 1:
        carried = from_earlier_ranges(tagged, machine, {"__before": F.max("__open")}, combine=F.max)
        merged = join_range_offsets(merged.filter(F.col("__kind") == 1), carried, machine)
        merged = merged.withColumn("__last", F.coalesce("__last", "__before")).drop("__before")
    return (
        merged.filter(F.col("__kind") == 1)
        .withColumn(roles.failure_id, F.col("__last.failure_id"))
        .drop(RANGE, TIE, "__kind", "__open", "__last")
    )


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(ref(label)).agg(F.count("*").alias("row_count")).orderBy(ref(label))


def failure_periods(df: DataFrame, roles: SeriesRoles) -> DataFrame:
    """Rows, first and last time of each failure."""
    return (
        df.filter(ref(roles.label) == 1)
        .groupBy(ref(roles.failure_id))
        .agg(
            F.count("*").alias("row_count"),
            F.min(ref(roles.time)).alias("first_time"),
            F.max(ref(roles.time)).alias("last_time"),
        )
    )


def first_faults(df: DataFrame, roles: SeriesRoles, count: int = 20) -> DataFrame:
    return df.filter(ref(roles.label) == 1).orderBy(*refs(roles.order)).limit(count)


def fault_percentage(df: DataFrame, label: str) -> DataFrame:
    totals = df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(ref(label) == 1).alias("fault_rows"),
    )
    share = ratio(F.col("fault_rows"), F.col("total_rows")) * 100
    return totals.withColumn("fault_percentage", F.coalesce(share, F.lit(0.0)))
