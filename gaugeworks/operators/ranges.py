"""Ordered windows over long series without a single-task sort.

A window without a partition key sorts the whole table in one task, and a
window partitioned by machine does so for the busiest machine.  Here the total
order ``(machine, time, tie-break)`` is cut into contiguous ranges of about
equal row counts.  The cut points come from a bounded sample and are literals
in the plan, so the range of a row is a function of the row alone: it survives
the loss of an executor and does not depend on the cluster.  Rows that share a
machine, a day or an instant are spread over as many ranges as they need.

Results never depend on where the cuts fall, only the balance does.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.columns import ref, refs
from gaugeworks.functions.search import boundaries_not_above

RANGE = "__range"
OWN_RANGE = "__own_range"
TIE = "__tie"

# One sort task handles about this many rows comfortably.
DEFAULT_ROWS_PER_RANGE = 4_000_000
# Bounds what the driver holds: a sample of the keys, two cut points per range
# and one row count per cell between cuts.
MAX_RANGES = 32_768
SAMPLES_PER_RANGE = 16

_JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

_KEY_TYPES = (
    T.IntegralType,
    T.DoubleType,
    T.FloatType,
    T.StringType,
    T.TimestampType,
    T.TimestampNTZType,
    T.DateType,
    T.DecimalType,
    T.BooleanType,
    T.BinaryType,
)


@dataclass(frozen=True)
class OrderedRanges:
    """Contiguous ranges ``0 .. count-1`` of a total order, ascending."""

    order: tuple[str, ...]
    count: int
    rows: int
    range_id: Column
    near_end: Column
    """True for rows that can be among the last ``keep_last`` rows of a range."""

    @staticmethod
    def plan(
        df: DataFrame,
        order: Sequence[str],
        rows_per_range: int = DEFAULT_ROWS_PER_RANGE,
        keep_last: int = 0,
        total_rows: int | None = None,
        seed: int = 42,
    ) -> OrderedRanges:
        """Choose the ranges.  Reads only the key columns of ``df``.

        Every range but the last holds at least ``keep_last`` rows.  Tables of
        up to ``rows_per_range`` rows get one range.
        """
        order = tuple(order)
        _check_key_types(df, order)
        total = df.count() if total_rows is None else total_rows
        if total <= rows_per_range:
            return OrderedRanges(order, 1, total, F.lit(0), F.lit(False))

        wanted = min(MAX_RANGES, math.ceil(total / rows_per_range))
        cuts = _cut_points(_key_frame(df, order), total, wanted, seed)
        cell = _cell_expression(order, cuts)
        found = {
            row["cell"]: row["n"]
            for row in df.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")).collect()
        }
        sizes = [found.get(index, 0) for index in range(len(cuts.values) + 1)]
        rows = sum(sizes)
        owner = _pack(sizes, [True, *cuts.starts], max(rows / wanted / 2, keep_last))
        tails = _tail_cells(sizes, owner, keep_last)
        return OrderedRanges(
            order,
            owner[-1] + 1,
            rows,
            F.element_at(_literal(owner, "array<int>"), cell + 1),
            F.element_at(_literal(tails, "array<boolean>"), cell + 1),
        )


@dataclass(frozen=True)
class _Cuts:
    """Sorted cut points; ``starts`` tells those that may begin a range."""

    values: list
    starts: list[bool]
    width: int
    schema: str


def _check_key_types(df: DataFrame, order: Sequence[str]) -> None:
    """The same keys are refused whatever the size of the table."""
    for name in order:
        if not isinstance(df.schema[name].dataType, _KEY_TYPES):
            raise TypeError(f"cannot order ranges by {name}: {df.schema[name].dataType.simpleString()}")


def _key_frame(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return df.select(*[ref(name).alias(f"k{i}") for i, name in enumerate(order)])


def _cut_points(keys: DataFrame, total: int, ranges: int, seed: int) -> _Cuts:
    """From a sorted sample of bounded size: where ranges begin, and where their last bit begins.

    The second kind of cut keeps the search for the last rows of a range to a
    sixteenth of the data.
    """
    fraction = min(1.0, ranges * SAMPLES_PER_RANGE / total)
    rows = (
        keys.sample(fraction, seed=seed)
        .repartition(1)
        .sortWithinPartitions(*keys.columns)
        .select(F.to_json(F.struct(*keys.columns), _JSON_OPTIONS).alias("key"))
        .collect()
    )
    exact = {f.name for f in keys.schema if isinstance(f.dataType, T.DecimalType)}
    sample = [
        # Decimals stay text, or their digits would go through a double.
        {k: (str(v) if k in exact else float(v) if isinstance(v, Decimal) else v) for k, v in key.items()}
        for key in (json.loads(row["key"], parse_float=Decimal) for row in rows)
    ]
    step = max(2, len(sample) // ranges)
    chosen = []
    for begin in range(0, len(sample), step):
        if begin:
            chosen.append((sample[begin], True))
        if begin + step - 1 < len(sample):
            chosen.append((sample[begin + step - 1], False))
    # Shorter keys compare faster: use the shortest prefix of the order that
    # still tells nearly all cut points apart.
    target = len(_distinct(chosen, len(keys.columns)))
    for width in range(1, len(keys.columns) + 1):
        kept = _distinct(chosen, width)
        if len(kept) >= 0.9 * target:
            break
    starts = [start for _, start in kept]
    if width == 1:
        # Null keys sort first and compare as null, which is below every cut.
        values = [key["k0"] for key, _ in kept if "k0" in key]
        starts = starts[len(starts) - len(values) :]
        return _Cuts(values, starts, width, f"array<{keys.schema[0].dataType.simpleString()}>")
    fields = ",".join(f"k{i}:{keys.schema[i].dataType.simpleString()}" for i in range(width))
    return _Cuts([key for key, _ in kept], starts, width, f"array<struct<{fields}>>")


def _distinct(cuts: list[tuple[dict, bool]], width: int) -> list[tuple[dict, bool]]:
    kept: list[tuple[dict, bool]] = []
    for key, start in cuts:
        prefix = {f"k{i}": key[f"k{i}"] for i in range(width) if f"k{i}" in key}
        if kept and kept[-1][0] == prefix:
            kept[-1] = (prefix, kept[-1][1] or start)
        else:
            kept.append((prefix, start))
    return kept


def _cell_expression(order: Sequence[str], cuts: _Cuts) -> Column:
    boundaries = _literal(cuts.values, cuts.schema)
    if cuts.width == 1:
        key = ref(order[0])
    else:
        key = F.struct(*[ref(name).alias(f"k{i}") for i, name in enumerate(order[: cuts.width])])
    return boundaries_not_above(boundaries, len(cuts.values), key)


def _literal(values: list, schema: str) -> Column:
    """An array literal; Catalyst folds the parse away when it optimizes the plan."""
    return F.from_json(F.lit(json.dumps(values)), schema, _JSON_OPTIONS)


def _pack(sizes: list[int], may_begin: list[bool], least: float) -> list[int]:
    """Number the ranges: a new one begins where it may, once the last has ``least`` rows."""
    owner, group, held = [], 0, 0
    for size, begins in zip(sizes, may_begin):
        if begins and held >= least and held:
            group, held = group + 1, 0
        owner.append(group)
        held += size
    if group and held < least:
        owner = [min(item, group - 1) for item in owner]
    return owner


def _tail_cells(sizes: list[int], owner: list[int], keep_last: int) -> list[bool]:
    tails = [False] * len(sizes)
    held, group = 0, None
    for index in range(len(sizes) - 1, -1, -1):
        if owner[index] != group:
            held, group = 0, owner[index]
        if held < keep_last:
            tails[index] = True
        held += sizes[index]
    return tails


def with_ordered_columns(
    df: DataFrame,
    build: Callable[[WindowSpec], dict[str, Column]],
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    lookback: int = 1,
    rows_per_range: int = DEFAULT_ROWS_PER_RANGE,
    total_rows: int | None = None,
) -> DataFrame:
    """Add window columns that look back at most ``lookback`` rows.

    ``build`` receives the window (partitioned and ordered) and returns the new
    columns by name.  ``partition_by + order_by`` must identify a row; with
    ties left open the result is as arbitrary as that of a plain window.

    Each range borrows the end of the range before it, ``lookback`` rows at
    least and some sixteenth of a range as a rule: the data is read and
    shuffled once, and no task sees more than one range.
    """
    order = (*partition_by, *order_by)
    ranges = OrderedRanges.plan(df, order, rows_per_range, lookback, total_rows)
    if ranges.count == 1:
        window = Window.partitionBy(*refs(partition_by)).orderBy(*refs(order_by))
        return df.withColumns(build(window))

    # A row near the end of a range goes to the next one as well, so the table is read and shuffled once.
    own = df.withColumn(OWN_RANGE, ranges.range_id)
    lent = ranges.near_end & (F.col(OWN_RANGE) < ranges.count - 1)
    places = F.when(lent, F.array(F.col(OWN_RANGE), F.col(OWN_RANGE) + 1)).otherwise(F.array(F.col(OWN_RANGE)))
    window = Window.partitionBy(RANGE, *refs(partition_by)).orderBy(*refs(order_by))
    return (
        own.withColumn(RANGE, F.explode(places))
        .withColumns(build(window))
        .filter(F.col(RANGE) == F.col(OWN_RANGE))
        .drop(RANGE, OWN_RANGE)
    )


def with_tie_break(df: DataFrame, time: str, seq: Sequence[str]) -> tuple[DataFrame, tuple[str, ...]]:
    """The frame and an order that is total.

    Where no tie-break column is named, a hash of the whole row takes its
    place: rows that still tie are equal in every column.
    """
    if seq:
        return df, (time, *seq)
    return df.withColumn(TIE, F.xxhash64(*refs(df.columns))), (time, TIE)


def with_group_row_number(
    df: DataFrame,
    group_by: Sequence[str],
    order_by: Sequence[str],
    name: str = "row_number",
    rows_per_range: int = DEFAULT_ROWS_PER_RANGE,
    total_rows: int | None = None,
) -> DataFrame:
    """Exact ``row_number`` inside groups of any size.

    Rows are numbered inside their range; a group that began in an earlier
    range starts from the number of its rows there.  At most one group per
    range is in that position, which bounds the broadcast by the range count.
    """
    ranges = OrderedRanges.plan(df, (*group_by, *order_by), rows_per_range, 0, total_rows)
    if ranges.count == 1:
        window = Window.partitionBy(*refs(group_by)).orderBy(*refs(order_by))
        return df.withColumn(name, F.row_number().over(window).cast("long"))

    tagged = df.withColumn(RANGE, ranges.range_id)
    before = from_earlier_ranges(tagged, group_by, {"__before": F.count("*")})
    window = Window.partitionBy(RANGE, *refs(group_by)).orderBy(*refs(order_by))
    numbered = tagged.withColumn("__in_range", F.row_number().over(window).cast("long"))
    return (
        join_range_offsets(numbered, before, group_by)
        .withColumn(name, F.col("__in_range") + F.coalesce("__before", F.lit(0)))
        .drop(RANGE, "__in_range", "__before")
    )


def from_earlier_ranges(
    tagged: DataFrame,
    group_by: Sequence[str],
    totals: dict[str, Column],
    descending: bool = False,
    combine: Callable[[str], Column] = F.sum,
) -> DataFrame:
    """Aggregates per (range, group), combined over the ranges before it in the same group.

    Only pairs with something before them are kept: at most one group per
    range continues from its neighbour, so the result has fewer rows than
    there are ranges.
    """
    direction = F.col(RANGE).desc() if descending else F.col(RANGE).asc()
    earlier = (
        Window.partitionBy(*refs(group_by))
        .orderBy(direction)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    per_range = tagged.groupBy(RANGE, *refs(group_by)).agg(
        *[total.alias(label) for label, total in totals.items()]
    )
    carried = per_range.withColumns({label: combine(label).over(earlier) for label in totals})
    return carried.filter(F.col(next(iter(totals))).isNotNull())


def join_range_offsets(tagged: DataFrame, offsets: DataFrame, group_by: Sequence[str]) -> DataFrame:
    """Left join on (range, group), nulls in the group matching each other."""
    left, right = tagged.alias("rows"), offsets.alias("offsets")
    condition = F.col(f"rows.{RANGE}") == F.col(f"offsets.{RANGE}")
    for name in group_by:
        quoted = "`" + name.replace("`", "``") + "`"
        condition = condition & F.col(f"rows.{quoted}").eqNullSafe(F.col(f"offsets.{quoted}"))
    extra = [name for name in offsets.columns if name != RANGE and name not in group_by]
    return left.join(F.broadcast(right), condition, "left").select(
        "rows.*", *[F.col(f"offsets.{name}") for name in extra]
    )
