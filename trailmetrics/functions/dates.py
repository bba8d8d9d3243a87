"""Date and time functions on TIMESTAMP_NTZ and DATE columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms of dates and times. TIME_INPUT takes hours of one
# or two digits, because stored action times do not pad the hour.
TIME_INPUT = "yyyy-MM-dd H:mm:ss"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DATE_KEY_FORMAT = "yyyyMMdd"
MINUTE_FORMAT = "yyyyMMddHHmm"
DATE_HOUR_FORMAT = "yyyy-MM-dd_HH"


def before(first: Column, second: Column) -> Column:
    return first < second


def after(first: Column, second: Column) -> Column:
    return first > second


def minus(first: Column, second: Column) -> Column:
    """Whole seconds from ``second`` to ``first``, as INT."""
    return F.timestamp_diff("SECOND", second, first).cast("int")


def date_hour(time: Column) -> Column:
    return F.date_format(time, DATE_HOUR_FORMAT)


def today() -> Column:
    return F.date_format(F.current_date(), DATE_FORMAT)


def yesterday() -> Column:
    return F.date_format(F.date_sub(F.current_date(), 1), DATE_FORMAT)


def format_date(time: Column) -> Column:
    return F.date_format(time, DATE_FORMAT)


def format_time(time: Column) -> Column:
    return F.date_format(time, TIME_FORMAT)


def parse_time(text: Column) -> Column:
    return F.to_timestamp_ntz(text, F.lit(TIME_INPUT))


def try_parse_time(text: Column) -> Column:
    """As `parse_time`; null for text of another form or a time that does not exist."""
    is_time = text.rlike(r"^\d{4}-\d{2}-\d{2} \d{1,2}:\d{2}:\d{2}$")
    return F.when(is_time, text.try_cast("timestamp_ntz"))


def format_date_key(time: Column) -> Column:
    return F.date_format(time, DATE_KEY_FORMAT)


def parse_date_key(text: Column) -> Column:
    return F.to_date(text, DATE_KEY_FORMAT)


def format_time_minute(time: Column) -> Column:
    return F.date_format(time, MINUTE_FORMAT)
