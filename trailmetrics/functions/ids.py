"""Ids, comma lists of ids, and membership tests on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmetrics.schemas import NO_CLICK


def explode_ids(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row per id of the comma list ``column``, in place of that column.

    Pieces that are no number are left out, as are rows without a list.
    """
    others = [other for other in df.columns if other != column]
    pieces = df.where(F.col(column).isNotNull()).select(
        *others, F.explode(F.split(column, ",")).alias(name)
    )
    return pieces.withColumn(name, F.col(name).try_cast("bigint")).where(F.col(name).isNotNull())


def is_click(identifier: Column) -> Column:
    return identifier.isNotNull() & (identifier != NO_CLICK)


def text_in(text: Column, values: Sequence[str]) -> Column:
    """True if an item of the comma list ``text`` is among the values.

    Missing data and the no-value mark ``-1`` give false.
    """
    items = F.array(*[F.lit(value) for value in values])
    return F.coalesce(
        (text != str(NO_CLICK)) & F.arrays_overlap(F.split(text, ","), items), F.lit(False)
    )


def any_in(array: Column, values: Sequence) -> Column:
    """True if the array shares an item with the values; a null array gives false."""
    items = F.array(*[F.lit(value) for value in values])
    return F.coalesce(F.arrays_overlap(array, items), F.lit(False))
