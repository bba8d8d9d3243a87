"""Repeatable sample of sessions, spread over days and hours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_SIZE = 100


def _by_hour(sessions: DataFrame) -> DataFrame:
    return sessions.withColumn("date", F.to_date("start_time")).withColumn(
        "hour", F.hour("start_time")
    )


def session_hour_count(sessions: DataFrame) -> DataFrame:
    """Sessions per day and hour of their start."""
    return _by_hour(sessions).groupBy("date", "hour").agg(F.count("*").alias("session_count"))


def session_extract_quota(
    hours: DataFrame, sample_size: int = SAMPLE_SIZE, extra: int = 1
) -> DataFrame:
    """How many sessions to draw from each hour.

    The sample is split evenly over the days, and over a day's hours by their
    share of its sessions, rounded down. ``extra`` sessions are added per hour, so
    that small hours are not left out, up to the hour's own count.

    ``hours`` has at most 24 rows per day, so the windows see little data however
    many sessions there are.
    """
    days = F.size(F.collect_set("date").over(Window.partitionBy()))
    day_total = F.sum("session_count").over(Window.partitionBy("date"))
    split = hours.withColumn("days", days).withColumn("day_count", day_total)
    share = F.expr(f"session_count * ({sample_size} div days) div day_count")
    return split.select(
        "date",
        "hour",
        "session_count",
        "day_count",
        F.least(F.col("session_count"), share + extra).alias("quota"),
    )


def session_random_extract(
    sessions: DataFrame,
    seed: int = 0,
    sample_size: int = SAMPLE_SIZE,
    extra: int = 1,
) -> DataFrame:
    """Draw each hour's quota of sessions, in the order of a seeded hash.

    The quotas are made here, so none exceeds ``sample_size + extra``. That
    constant bound cuts every hour in each task before the shuffle, so a crowded
    hour is never gathered whole; the hour's own quota then cuts exactly.
    ``quotas`` has at most 24 rows per day, so it is broadcast.
    """
    quotas = session_extract_quota(session_hour_count(sessions), sample_size, extra)
    order = F.md5(F.concat_ws("|", F.col("session_id"), F.lit(str(seed))))
    drawn = Window.partitionBy("date", "hour").orderBy(order, F.col("session_id"))
    return (
        _by_hour(sessions.select("session_id", "start_time"))
        .withColumn("rank", F.row_number().over(drawn))
        .where(F.col("rank") <= sample_size + extra)
        .join(F.broadcast(quotas.select("date", "hour", "quota")), ["date", "hour"])
        .where(F.col("rank") <= F.col("quota"))
        .select("session_id", "start_time", "date", "hour")
    )
