"""Expressions of the run log."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds that passed from ``start`` to ``end``; null if either is."""
    return F.timestamp_diff("SECOND", start, end)
