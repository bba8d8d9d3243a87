"""String functions, including the `k=v|k=v` record form."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_empty(text: Column) -> Column:
    return text.isNull() | (text == "")


def is_not_empty(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def trim_comma(text: Column) -> Column:
    """Drop one comma at either end."""
    return F.regexp_replace(text, "^,|,$", "")


def pad_two(text: Column) -> Column:
    """Prefix one ``0`` unless the text has two characters."""
    return F.when(F.length(text) == 2, text).otherwise(F.concat(F.lit("0"), text))


def concat_long_string(number: Column, text: Column, separator: str = ":") -> Column:
    return F.concat(number.cast("string"), F.lit(separator), text)


def json_field(document: Column, field: str) -> Column:
    """Value of a top-level field as text; null if missing or not valid JSON."""
    return F.get_json_object(document, f"$.{field}")


def group_concat_distinct(text: Column, separator: str = ",") -> Column:
    """Aggregate: the distinct values in binary order, joined."""
    return F.array_join(F.array_sort(F.collect_set(text)), separator)


def joined_or_null(values: Column) -> Column:
    """Comma list of an array; null when it is empty."""
    return F.when(F.size(values) > 0, F.array_join(values, ","))


def _pieces(record: Column, delimiter: str) -> Column:
    return F.split(record, re.escape(delimiter))


def get_field(record: Column, delimiter: str, field: str) -> Column:
    """Value of the first piece ``field=value``.

    A piece counts only if it has exactly one key and one non-empty value, so an
    empty value, or one that holds ``=``, gives null. ``=`` signs at the end of a
    piece are ignored.
    """
    parts = F.transform(_pieces(record, delimiter), lambda p: F.split(F.rtrim(p, F.lit("=")), "="))
    matching = F.filter(parts, lambda kv: (F.size(kv) == 2) & (kv[0] == field))
    return F.get(matching, F.lit(0))[1]


def set_field(record: Column, delimiter: str, field: str, value: Column) -> Column:
    """Replace the value of one key; other pieces and their order stay."""
    replacement = F.concat(F.lit(field + "="), value)
    pieces = F.transform(
        _pieces(record, delimiter),
        lambda p: F.when(F.split(p, "=")[0] == field, replacement).otherwise(p),
    )
    return F.array_join(pieces, delimiter)
