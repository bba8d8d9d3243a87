"""Number functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def format_double(value: Column, scale: int) -> Column:
    """Round half up on the decimal form of the double."""
    return F.round(value, scale)


def ratio(part: Column, whole: Column, scale: int = 2) -> Column:
    """part / whole, rounded; null when the whole is 0."""
    return format_double(F.try_divide(part.cast("double"), whole.cast("double")), scale)
