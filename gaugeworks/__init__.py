"""Fault analytics on sensor time series, written as Spark DataFrame operators."""

from gaugeworks.roles import SeriesRoles
from gaugeworks.session import build_session

__all__ = ["SeriesRoles", "build_session"]
