"""Time helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``.  On TIMESTAMP_NTZ values this
    is wall-clock arithmetic (no DST or zone shifts); on TIMESTAMP values it
    is the exact instant difference."""
    return F.timestamp_diff("SECOND", start, end)
