"""Action details of a few chosen sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmetrics.functions import dates


def session_detail(actions: DataFrame, chosen: DataFrame, dedupe: bool = True) -> DataFrame:
    """The actions of the chosen sessions; actions without a session id are one session.

    Pass sessions that are written down, so that Spark knows their size: few are
    then broadcast, and the actions are not shuffled. With ``dedupe=False`` a
    session that is chosen k times gives its actions k times.
    """
    sessions = chosen.select(F.col("session_id").alias("chosen_id"))
    matched = actions.join(
        sessions,
        F.col("session_id").eqNullSafe(F.col("chosen_id")),
        "left_semi" if dedupe else "inner",
    )
    return matched.select(
        F.col("user_id").alias("userid"),
        F.col("session_id").alias("sessionid"),
        F.col("page_id").alias("pageid"),
        dates.format_time(F.col("action_time")).alias("actionTime"),
        F.col("search_keyword").alias("searchKeyword"),
        F.col("click_category_id").alias("clickCategoryId"),
        F.col("click_product_id").alias("clickProductId"),
        F.col("order_category_ids").alias("orderCategoryIds"),
        F.col("order_product_ids").alias("orderProductIds"),
        F.col("pay_category_ids").alias("payCategoryIds"),
        F.col("pay_product_ids").alias("payProductIds"),
    )
