"""Sessions from stored daily parts, so that a date range need not scan its actions.

A table holds, for each day, one row per session, search word and clicked category
(`sessions.PART`). Rows of different days combine, also where a session crosses
midnight. A new day adds its own rows only, and a day that is stored again replaces
what was there.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmetrics.operators import sessions
from trailmetrics.sinks import replace_partitions


def day_parts(actions: DataFrame) -> DataFrame:
    """The parts of each day, counted in each task before they are shuffled."""
    return sessions.combined(sessions.action_parts(actions, "date"), "date").select(
        *sessions.PART, "date"
    )


def store_days(actions: DataFrame, name: str) -> list[str]:
    """Store the days that the actions are of; returns the folders that they replace.

    Give each day whole. The table is stored by day, and is made if there is none.
    """
    return replace_partitions(day_parts(actions), name, "date")


def stored_parts(spark: SparkSession, name: str, start: dt.date, end: dt.date) -> DataFrame:
    """The parts of the days from start to end, both included; reads those days only."""
    in_range = F.col("date").between(F.lit(start), F.lit(end))
    return spark.table(name).where(in_range).select(*sessions.PART)
