from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percentage(part: Column, whole: Column) -> Column:
    """Share in percent as DOUBLE, six places; null when the whole is zero."""
    return F.round(F.lit(100.0) * part / F.nullif(whole, F.lit(0)), 6)


def outside(value: Column, low: float, high: float) -> Column:
    return (value < low) | (value > high)
