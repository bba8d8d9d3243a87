"""Schemas of the input tables and column lists of the result tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Action times usually have whole seconds; `operators.pages` says what fractions of a
# second need. The id lists stay comma separated text, as stored;
# `functions.ids.explode_ids` gives a row per id.
USER_VISIT_ACTION = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("action_time", T.TimestampNTZType()),
        T.StructField("search_keyword", T.StringType()),
        T.StructField("click_category_id", T.LongType()),
        T.StructField("click_product_id", T.LongType()),
        T.StructField("order_category_ids", T.StringType()),
        T.StructField("order_product_ids", T.StringType()),
        T.StructField("pay_category_ids", T.StringType()),
        T.StructField("pay_product_ids", T.StringType()),
        T.StructField("city_id", T.LongType()),
    ]
)

USER_INFO = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("username", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("professional", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("sex", T.StringType()),
    ]
)

PRODUCT_INFO = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("extend_info", T.StringType()),
    ]
)

CITY_INFO = T.StructType(
    [
        T.StructField("city_id", T.LongType()),
        T.StructField("city_name", T.StringType()),
        T.StructField("area", T.StringType()),
    ]
)

# Id written where an action has no click.
NO_CLICK = -1

# Names and order of the result tables' columns. Each table is
# preceded by the `taskid` of the run when it is written.
RESULT_COLUMNS = {
    "session_aggr_stat": [
        "session_count",
        "visit_length_1s_3s_ratio",
        "visit_length_4s_6s_ratio",
        "visit_length_7s_9s_ratio",
        "visit_length_10s_30s_ratio",
        "visit_length_30s_60s_ratio",
        "visit_length_1m_3m_ratio",
        "visit_length_3m_10m_ratio",
        "visit_length_10m_30m_ratio",
        "visit_length_30m_ratio",
        "step_length_1_3_ratio",
        "step_length_4_6_ratio",
        "step_length_7_9_ratio",
        "step_length_10_30_ratio",
        "step_length_30_60_ratio",
        "step_length_60_ratio",
    ],
    "session_random_extract": [
        "sessionid",
        "startTime",
        "searchKeywords",
        "clickCategoryIds",
    ],
    "session_detail": [
        "userid",
        "sessionid",
        "pageid",
        "actionTime",
        "searchKeyword",
        "clickCategoryId",
        "clickProductId",
        "orderCategoryIds",
        "orderProductIds",
        "payCategoryIds",
        "payProductIds",
    ],
    "top10_category": ["categoryid", "clickCount", "orderCount", "payCount"],
    "top10_session": ["categoryid", "sessionid", "clickCount"],
    "page_split_convert_rate": ["convertRate"],
    "area_top3_product": [
        "area",
        "areaLevel",
        "productid",
        "cityInfos",
        "clickCount",
        "productName",
        "productStatus",
    ],
}
