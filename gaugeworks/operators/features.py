"""Model features: differences, rolling statistics and the time of day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from gaugeworks.functions.columns import cyclic_hour, ref
from gaugeworks.operators.ranges import DEFAULT_ROWS_PER_RANGE
from gaugeworks.operators.sequence import (
    ROLLING_ROWS,
    delta_expressions,
    frames_by_lookup,
    gap_expression,
    in_order,
    lookup_expressions,
    rolling_expressions,
    rolling_names,
    with_rolling_statistics,
    with_window_columns,
)
from gaugeworks.roles import SeriesRoles


def time_expressions(time: str) -> dict[str, Column]:
    """hour, minute, day_of_week (Sunday is 1) and the hour as a point on a circle."""
    moment = ref(time)
    sine, cosine = cyclic_hour(F.hour(moment))
    return {
        "hour": F.hour(moment),
        "minute": F.minute(moment),
        "day_of_week": F.dayofweek(moment),
        "hour_sin": sine,
        "hour_cos": cosine,
    }


def with_features(
    df: DataFrame,
    roles: SeriesRoles,
    rows: int = ROLLING_ROWS,
    gap: str | None = None,
    rows_per_range: int = DEFAULT_ROWS_PER_RANGE,
) -> DataFrame:
    """All features in one pass: one shuffle, one sort, one window operator.

    ``gap`` also adds the seconds since the previous reading under that name.
    """
    looked_up = frames_by_lookup(df, roles.analog, rows)
    framed = [name for name in roles.analog if name not in looked_up]

    def build(window: WindowSpec) -> dict[str, Column]:
        columns = {
            **delta_expressions(window, roles.analog),
            **rolling_expressions(window, framed, rows),
            **lookup_expressions(window, looked_up, rows),
        }
        if gap is not None:
            columns[gap] = gap_expression(window, roles.time)
        return columns

    found = with_rolling_statistics(with_window_columns(df, roles, build, rows - 1, rows_per_range), looked_up, rows)
    made = [*[f"{name}_delta" for name in roles.analog], *rolling_names(roles.analog), *([] if gap is None else [gap])]
    return in_order(found, df, made).withColumns(time_expressions(roles.time))
