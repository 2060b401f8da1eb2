"""Lag, gap and rolling columns over the readings of a machine in time order."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.columns import epoch_seconds, ref, refs
from gaugeworks.operators.ranges import (
    DEFAULT_ROWS_PER_RANGE,
    TIE,
    with_ordered_columns,
    with_tie_break,
)
from gaugeworks.roles import SeriesRoles

GAP = "time_since_previous_seconds"
# Fixed value: rows in a rolling frame, current one included.
ROLLING_ROWS = 30
# Fixed value: seconds a five-minute frame reaches back at a ten-second step.
ROLLING_SECONDS = 290
# Frames of more rows are aggregated as they move.
MOST_LOOKED_UP = 60
# With fewer sensors to share a lookup, moving frames are faster.
LEAST_SENSORS_LOOKED_UP = 3
BLOCK = "__block"
PLACE = "__place"
EARLIER = "__earlier"


def gap_expression(window: WindowSpec, time: str) -> Column:
    """Whole seconds since the previous reading; null on the first one."""
    moment = ref(time)
    return epoch_seconds(moment) - epoch_seconds(F.lag(moment).over(window))


def delta_expressions(window: WindowSpec, sensors: Sequence[str]) -> dict[str, Column]:
    return {f"{name}_delta": ref(name) - F.lag(ref(name)).over(window) for name in sensors}


def rolling_expressions(window: WindowSpec, sensors: Sequence[str], rows: int = ROLLING_ROWS) -> dict[str, Column]:
    frame = window.rowsBetween(1 - rows, 0)
    statistics = (("mean", F.avg), ("std", F.stddev), ("min", F.min), ("max", F.max))
    return {
        f"{name}_rolling_{kind}_5m": aggregate(ref(name)).over(frame)
        for name in sensors
        for kind, aggregate in statistics
    }


def rolling_names(sensors: Sequence[str]) -> list[str]:
    return [f"{name}_rolling_{kind}_5m" for name in sensors for kind in ("mean", "std", "min", "max")]


def in_order(found: DataFrame, df: DataFrame, made: Sequence[str]) -> DataFrame:
    """The columns of ``df``, then those made beside them."""
    return found.select(*refs(df.columns), *refs([name for name in made if name not in df.columns]))


def _looked_up(name: str, back: int) -> str:
    return f"__{back}_before_{name}"


def _near(name: str) -> str:
    return f"__near_{name}"


def _known(name: str) -> str:
    return f"__known_{name}"


def frames_by_lookup(df: DataFrame, sensors: Sequence[str], rows: int) -> list[str]:
    """Sensors whose rolling statistics come from readings looked up, not from a frame that moves.

    Means of decimals stay decimals, and long frames would need too many lookups.
    """
    if rows > MOST_LOOKED_UP:
        return []
    found = [name for name in sensors if not isinstance(df.schema[name].dataType, T.DecimalType)]
    return found if len(found) >= LEAST_SENSORS_LOOKED_UP else []


def lookup_expressions(window: WindowSpec, sensors: Sequence[str], rows: int = ROLLING_ROWS) -> dict[str, Column]:
    """The readings of a frame, a column for each, the last one and the number of those that are not null.

    ``with_rolling_statistics`` makes the statistics of them.

    A lookup costs the same however far back it goes, while a frame that moves
    along is aggregated anew for every row and statistic.
    """
    known, before = window.rowsBetween(Window.unboundedPreceding, 0), window.rowsBetween(Window.unboundedPreceding, -rows)
    return {
        **{_looked_up(name, back): F.lag(ref(name), back).over(window) for back in range(rows - 1, 0, -1) for name in sensors},
        **{_near(name): F.last(ref(name).cast("double"), ignorenulls=True).over(known) for name in sensors},
        **{_known(name): F.count(ref(name)).over(known) - F.count(ref(name)).over(before) for name in sensors},
    }


def with_rolling_statistics(df: DataFrame, sensors: Sequence[str], rows: int = ROLLING_ROWS) -> DataFrame:
    """The columns of ``rolling_expressions`` in place of those of ``lookup_expressions``.

    Squares are taken around a reading of the frame: what cancels is bounded by
    the range of the frame, whatever its level, and equal readings have a
    spread of exactly zero.
    """
    columns: dict[str, Column] = {}
    for name in sensors:
        # The oldest first, as a frame is summed up.
        values = [*[ref(_looked_up(name, back)) for back in range(rows - 1, 0, -1)], ref(name)]
        numbers = [value.cast("double") for value in values]
        off = [number - ref(_near(name)) for number in numbers]
        n = ref(_known(name))
        total, above, squares = (
            sum((F.coalesce(term, F.lit(0.0)) for term in terms), F.lit(0.0)) for terms in (numbers, off, [one * one for one in off])
        )
        rest = F.greatest(squares - F.try_divide(above * above, n), F.lit(0.0))
        columns |= {
            f"{name}_rolling_mean_5m": F.try_divide(total, _compiled_apart(n)),
            f"{name}_rolling_std_5m": F.when(n > 1, F.sqrt(F.try_divide(rest, n - 1))),
            f"{name}_rolling_min_5m": F.least(*values, values[-1]),
            f"{name}_rolling_max_5m": F.greatest(*values, values[-1]),
        }
    helpers = [*[_looked_up(name, back) for name in sensors for back in range(1, rows)], *map(_near, sensors), *map(_known, sensors)]
    return df.withColumns(columns).drop(*helpers)


def _compiled_apart(value: Column) -> Column:
    """The value, by a function that Spark does not compile.

    A projection with one is compiled in many methods; as part of one method for
    the whole stage, sums over all readings are too long for the JIT.
    """
    return F.element_at(F.transform(F.array(value), lambda one: one), 1)


def with_window_columns(
    df: DataFrame,
    roles: SeriesRoles,
    build: Callable[[WindowSpec], dict[str, Column]],
    lookback: int,
    rows_per_range: int = DEFAULT_ROWS_PER_RANGE,
) -> DataFrame:
    """Window columns over the readings of each machine in time order."""
    tied, order = with_tie_break(df, roles.time, roles.seq)
    found = with_ordered_columns(
        tied, build, order, roles.machine, lookback=lookback, rows_per_range=rows_per_range
    )
    return found.drop(TIE)


def with_time_gap(
    df: DataFrame, roles: SeriesRoles, name: str = GAP, rows_per_range: int = DEFAULT_ROWS_PER_RANGE
) -> DataFrame:
    return with_window_columns(
        df, roles, lambda window: {name: gap_expression(window, roles.time)}, 1, rows_per_range
    )


def with_deltas(df: DataFrame, roles: SeriesRoles, rows_per_range: int = DEFAULT_ROWS_PER_RANGE) -> DataFrame:
    return with_window_columns(
        df, roles, lambda window: delta_expressions(window, roles.analog), 1, rows_per_range
    )


def with_rolling(
    df: DataFrame,
    roles: SeriesRoles,
    rows: int = ROLLING_ROWS,
    rows_per_range: int = DEFAULT_ROWS_PER_RANGE,
) -> DataFrame:
    looked_up = frames_by_lookup(df, roles.analog, rows)
    framed = [name for name in roles.analog if name not in looked_up]

    def build(window: WindowSpec) -> dict[str, Column]:
        return {**rolling_expressions(window, framed, rows), **lookup_expressions(window, looked_up, rows)}

    found = with_window_columns(df, roles, build, rows - 1, rows_per_range)
    return in_order(with_rolling_statistics(found, looked_up, rows), df, rolling_names(roles.analog))


def time_rolling(
    df: DataFrame,
    roles: SeriesRoles,
    seconds: int = ROLLING_SECONDS,
    rows_per_range: int = DEFAULT_ROWS_PER_RANGE,
) -> DataFrame:
    """Rolling statistics over the last ``seconds`` seconds, one row per machine and second.

    All readings of one second share a frame, so they are merged before the
    window.  Time is cut into blocks as long as a frame: a frame is the begin of
    its own block and the end of the block before, so both are running
    aggregates and a row costs the same however many seconds its frame holds.
    No block has more than ``2 * (seconds + 1)`` rows; ``rows_per_range`` is
    taken as by the other operators, but no series is long enough to be cut.
    Join on machine and ``epoch`` to put the result next to the readings.
    """
    keys = [*roles.machine, "epoch"]
    at_second = df.filter(ref(roles.time).isNotNull()).withColumn("epoch", epoch_seconds(ref(roles.time)))
    parts = []
    for i, name in enumerate(roles.analog):
        value = ref(name).cast("double")
        parts += [
            F.count(value).alias(f"n{i}"),
            F.sum(value).alias(f"s{i}"),
            (F.var_pop(value) * F.count(value)).alias(f"m{i}"),
            F.min(value).alias(f"lo{i}"),
            F.max(value).alias(f"hi{i}"),
        ]
    # Deviations are taken around the mean of a machine in a block of time: neither the level of
    # another machine nor a drift over days swallows the spread.
    block = Window.partitionBy(*refs(roles.machine), BLOCK)
    merged = at_second.groupBy(*refs(keys)).agg(*parts).withColumns(
        {BLOCK: F.floor(F.col("epoch") / (seconds + 1)), PLACE: F.pmod(F.col("epoch"), F.lit(seconds + 1)), EARLIER: F.lit(False)}
    )
    # For the second at place p of a block, the frame begins at place p + 1 of the block before.
    asked = merged.select(
        *refs(keys), (F.col(BLOCK) - 1).alias(BLOCK), (F.col(PLACE) + 1).alias(PLACE), F.lit(True).alias(EARLIER)
    )
    placed = merged.unionByName(asked, allowMissingColumns=True)
    placed = placed.withColumns({f"c{i}": F.avg(F.try_divide(f"s{i}", f"n{i}")).over(block) for i in range(len(roles.analog))})
    centred: dict[str, Column] = {}
    for i in range(len(roles.analog)):
        n, off = F.col(f"n{i}"), F.try_divide(f"s{i}", f"n{i}") - F.col(f"c{i}")
        centred[f"o{i}"] = n * off
        centred[f"q{i}"] = F.col(f"m{i}") + n * off * off
    placed = placed.withColumns(centred)
    begin, end = (block.orderBy(order).rangeBetween(Window.unboundedPreceding, 0) for order in (F.col(PLACE).asc(), F.col(PLACE).desc()))
    running: dict[str, Column] = {}
    for i in range(len(roles.analog)):
        for kind, aggregate in (("n", F.sum), ("s", F.sum), ("o", F.sum), ("q", F.sum), ("lo", F.min), ("hi", F.max)):
            own = F.col(f"{kind}{i}")
            running[f"r{kind}{i}"] = F.when(F.col(EARLIER), aggregate(own).over(end)).otherwise(aggregate(own).over(begin))
    halves = []
    for i in range(len(roles.analog)):
        for half, earlier in enumerate((False, True)):
            mine = F.col(EARLIER) == earlier
            halves += [F.max(F.when(mine, F.col(f"r{kind}{i}"))).alias(f"{kind}{i}_{half}") for kind in ("n", "s", "o", "q", "lo", "hi")]
            halves.append(F.max(F.when(mine, F.col(f"c{i}"))).alias(f"c{i}_{half}"))
    framed = placed.withColumns(running).groupBy(*refs(keys)).agg(*halves)
    columns: list[Column] = []
    for i, name in enumerate(roles.analog):
        own = {kind: [F.col(f"{kind}{i}_{half}") for half in (0, 1)] for kind in ("n", "s", "o", "q", "lo", "hi", "c")}
        n, total = (sum(F.coalesce(part, F.lit(0)) for part in own[kind]) for kind in ("n", "s"))
        low, high = F.least(*own["lo"]), F.greatest(*own["hi"])
        squares = F.greatest(_squares_of_halves(own), F.lit(0.0))
        columns += [
            F.try_divide(total, n).alias(f"{name}_rolling_mean_5m"),
            F.when(n > 1, F.when(low == high, 0.0).otherwise(F.sqrt(F.try_divide(squares, n - 1)))).alias(f"{name}_rolling_std_5m"),
            low.alias(f"{name}_rolling_min_5m"),
            high.alias(f"{name}_rolling_max_5m"),
        ]
    return framed.select(*refs(keys), *columns)


def _squares_of_halves(own: dict[str, list[Column]]) -> Column:
    """Squared deviations from the mean of a frame: those of its two blocks, and what lies between their means."""
    n = [F.coalesce(part, F.lit(0)) for part in own["n"]]
    off = [F.try_divide(total, part) for total, part in zip(own["o"], n)]
    squares = [F.coalesce(part - mean * mean * size, F.lit(0.0)) for part, mean, size in zip(own["q"], off, n)]
    apart = (own["c"][0] - own["c"][1]) + (off[0] - off[1])
    between = F.coalesce(F.try_divide(apart * apart * n[0] * n[1], n[0] + n[1]), F.lit(0.0))
    return squares[0] + squares[1] + between


def with_time_rolling(df: DataFrame, roles: SeriesRoles, seconds: int = ROLLING_SECONDS, **options) -> DataFrame:
    """``time_rolling`` joined back to the readings.

    The join key is unique on the rolled side; adaptive execution splits the
    readings of a crowded second over several tasks.
    """
    rolled = time_rolling(df, roles, seconds, **options)
    keyed = df.withColumn("epoch", epoch_seconds(ref(roles.time)))
    return keyed.join(rolled, [*roles.machine, "epoch"], "left").drop("epoch")


def first_rows(df: DataFrame, roles: SeriesRoles, count: int = 10, columns: Sequence[str] | None = None) -> DataFrame:
    shown = refs(columns or df.columns)
    return df.orderBy(*[ref(name).asc() for name in roles.order]).limit(count).select(*shown)


def last_rows(df: DataFrame, roles: SeriesRoles, count: int = 10, columns: Sequence[str] | None = None) -> DataFrame:
    shown = refs(columns or df.columns)
    return df.orderBy(*[ref(name).desc() for name in roles.order]).limit(count).select(*shown)


def exemplar_rows(df: DataFrame, roles: SeriesRoles) -> DataFrame:
    """First fault reading of every machine, its first reading when it has none.

    Each task keeps one candidate per machine before the shuffle.
    """
    window = Window.partitionBy(*refs(roles.machine)).orderBy(
        ref(roles.label).desc(), *[ref(name).asc() for name in roles.order]
    )
    return (
        df.withColumn("__rank", F.row_number().over(window)).filter(F.col("__rank") == 1).drop("__rank")
    )
