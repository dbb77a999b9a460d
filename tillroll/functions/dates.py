"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday display order used by the weekday charts.
DOW_ORDER = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def day_name(d: Column) -> Column:
    """Full English weekday name (``dayname`` would give the 3-letter form)."""
    return F.date_format(d, "EEEE")


def is_weekend(d: Column) -> Column:
    """Saturday or Sunday (Spark's dayofweek: 1 = Sunday, 7 = Saturday)."""
    return F.dayofweek(d).isin(1, 7)
