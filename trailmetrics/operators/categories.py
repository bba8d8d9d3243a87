"""Click, order and payment counts per category, and the top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmetrics.functions import ids

TOP_CATEGORIES = 10
TOP_SESSIONS = 10


def _clicked(keep_sentinel: bool) -> Column:
    category = F.col("click_category_id")
    return category.isNotNull() if keep_sentinel else ids.is_click(category)


def category_click_count(actions: DataFrame, keep_sentinel: bool = False) -> DataFrame:
    """Clicks per category. ``keep_sentinel`` also counts the no-click id -1."""
    return (
        actions.where(_clicked(keep_sentinel))
        .groupBy(F.col("click_category_id").alias("category_id"))
        .agg(F.count("*").alias("click_count"))
    )


def _list_count(actions: DataFrame, column: str, name: str) -> DataFrame:
    return (
        ids.explode_ids(actions.select(column), column, "category_id")
        .groupBy("category_id")
        .agg(F.count("*").alias(name))
    )


def category_order_count(actions: DataFrame) -> DataFrame:
    return _list_count(actions, "order_category_ids", "order_count")


def category_pay_count(actions: DataFrame) -> DataFrame:
    return _list_count(actions, "pay_category_ids", "pay_count")


def _activities(actions: DataFrame, *keep: str, keep_sentinel: bool = False) -> DataFrame:
    """One row per category that an action clicks, orders or pays, from one scan."""
    clicked = F.when(_clicked(keep_sentinel), F.col("click_category_id").cast("string"))
    lists = actions.select(
        *keep,
        F.stack(
            F.lit(3),
            F.lit("click"),
            clicked,
            F.lit("order"),
            F.col("order_category_ids"),
            F.lit("pay"),
            F.col("pay_category_ids"),
        ).alias("kind", "ids"),
    )
    return ids.explode_ids(lists, "ids", "category_id")


def active_categories(actions: DataFrame, keep_sentinel: bool = False) -> DataFrame:
    """Categories with at least one click, order or payment."""
    return _activities(actions, keep_sentinel=keep_sentinel).select("category_id").distinct()


def kind_counts(actions: DataFrame, keep_sentinel: bool = False) -> DataFrame:
    """Clicks, orders and payments per category, a row for each kind that occurs."""
    return (
        _activities(actions, keep_sentinel=keep_sentinel)
        .groupBy("category_id", "kind")
        .agg(F.count("*").alias("times"))
    )


def of_kind(counts: DataFrame, kind: str) -> DataFrame:
    """The counts of one kind, as `category_click_count` and its like return them."""
    return counts.where(F.col("kind") == kind).select(
        "category_id", F.col("times").alias(f"{kind}_count")
    )


def category_counts_joined(
    categories: DataFrame, clicks: DataFrame, orders: DataFrame, pays: DataFrame
) -> DataFrame:
    """Categories left-joined to the three counts; a missing count is 0."""
    joined = categories
    for counts in (clicks, orders, pays):
        joined = joined.join(counts, "category_id", "left")
    return joined.select(
        "category_id",
        *[
            F.coalesce(F.col(name), F.lit(0)).alias(name)
            for name in ("click_count", "order_count", "pay_count")
        ],
    )


def _kind_counts() -> list[Column]:
    return [
        F.count_if(F.col("kind") == kind).alias(f"{kind}_count")
        for kind in ("click", "order", "pay")
    ]


def category_counts(actions: DataFrame, keep_sentinel: bool = False) -> DataFrame:
    """The three counts per category from one scan and one shuffle."""
    return (
        _activities(actions, keep_sentinel=keep_sentinel)
        .groupBy("category_id")
        .agg(*_kind_counts())
    )


def with_activity(actions: DataFrame, keep_sentinel: bool = False) -> DataFrame:
    """Actions that click, order or pay something, with what the counts need."""
    active = (
        _clicked(keep_sentinel)
        | F.col("order_category_ids").isNotNull()
        | F.col("pay_category_ids").isNotNull()
    )
    return actions.where(active).select(
        "session_id", "click_category_id", "order_category_ids", "pay_category_ids"
    )


def top10_category(counts: DataFrame, n: int = TOP_CATEGORIES) -> DataFrame:
    """The first categories by clicks, then orders, then payments, then id."""
    return counts.orderBy(
        F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id")
    ).limit(n)


def category_session_click_count(actions: DataFrame, keep_sentinel: bool = False) -> DataFrame:
    """Clicks per category and session. The no-click id -1, if kept, has 0 clicks."""
    category = F.col("click_category_id")
    return (
        actions.where(_clicked(keep_sentinel))
        .groupBy(category.alias("category_id"), "session_id")
        .agg(F.count_if(ids.is_click(category)).alias("click_count"))
    )


def top_category_clicks(
    actions: DataFrame,
    sessions: DataFrame,
    top_categories: DataFrame,
    keep_sentinel: bool = False,
) -> DataFrame:
    """Clicks per top category and session, of the given sessions only.

    The actions are first reduced to the top categories, which are few enough to
    broadcast, and counted. A session that holds a large part of all clicks is then
    one row per top category and task when it is shuffled.
    """
    wanted = F.broadcast(top_categories.select(F.col("category_id").alias("click_category_id")))
    clicks = actions.select("session_id", "click_category_id").join(
        wanted, "click_category_id", "left_semi"
    )
    counts = category_session_click_count(clicks, keep_sentinel)
    given = sessions.select(F.col("session_id").alias("given_id"))
    # Clicks without a session id are a session like any other.
    return counts.join(given, F.col("session_id").eqNullSafe(F.col("given_id")), "left_semi")


def top10_session(session_clicks: DataFrame, n: int = TOP_SESSIONS) -> DataFrame:
    """The sessions with the most clicks in each category."""
    most_clicks = Window.partitionBy("category_id").orderBy(
        F.desc("click_count"), F.asc("session_id")
    )
    return (
        session_clicks.withColumn("rank", F.row_number().over(most_clicks))
        .where(F.col("rank") <= n)
        .select("category_id", "session_id", "click_count")
    )
