"""The clickstream tables as views of the star-schema parquet files.

One session per user and day. The day is compressed 40:1, so that visits last up
to 36 minutes, and starts at an hour that depends on the user.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmetrics.sources import tables

_ACTIONS = """
SELECT d AS date,
       user_id,
       concat_ws('-', user_id, date_format(d, 'yyyyMMdd')) AS session_id,
       k % 10 AS page_id,
       cast(d AS timestamp_ntz)
         + make_dt_interval(0, cast(user_id % 23 AS int), 0, cast(sod div 40 AS int)) AS action_time,
       CASE WHEN event_type = 'view' THEN concat('kw', k % 10) END AS search_keyword,
       CASE WHEN event_type = 'click' THEN k % 20 ELSE -1 END AS click_category_id,
       CASE WHEN event_type = 'click' THEN k ELSE -1 END AS click_product_id,
       CASE WHEN event_type = 'signup' THEN concat_ws(',', k % 20, (k + 7) % 20) END
         AS order_category_ids,
       CASE WHEN event_type = 'signup' THEN concat_ws(',', k, (k + 7) % 100) END
         AS order_product_ids,
       CASE WHEN event_type = 'purchase' THEN cast(k % 20 AS string) END AS pay_category_ids,
       CASE WHEN event_type = 'purchase' THEN cast(k AS string) END AS pay_product_ids,
       event_id % 10 AS city_id
FROM (
  SELECT event_id, user_id, event_type,
         to_date(ts) AS d,
         cast(get_json_object(props, '$.k') AS bigint) AS k,
         hour(ts) * 3600 + minute(ts) * 60 + cast(floor(second(ts)) AS int) AS sod
  FROM {events}
)
"""

_USERS = """
SELECT c_custkey AS user_id,
       c_name AS username,
       c_name AS name,
       cast(floor(abs(c_acctbal)) AS int) % 60 AS age,
       c_mktsegment AS professional,
       n_name AS city,
       CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
"""

_PRODUCTS = """
SELECT p_partkey AS product_id,
       p_name AS product_name,
       concat('{{"product_status": ', p_size % 2, '}}') AS extend_info
FROM {part}
"""

_AD_LINES = """
SELECT concat_ws(' ',
         timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts),
         concat('P', user_id % 5),
         concat('C', event_id % 10),
         user_id,
         cast(get_json_object(props, '$.k') AS bigint) % 20) AS value
FROM {events}
"""


# Stated, so that no job has to look into the files before a query is planned.
_SCHEMAS = {
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string"
    ),
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_size int",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events")


def user_visit_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_ACTIONS, events=events(spark, sf_dir))


def text_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The actions as text files have them, some days, users and times malformed."""
    number = "(user_id + page_id)"
    return user_visit_action(spark, sf_dir).selectExpr(
        f"if({number} % 19 = 0, concat(date, 'x'), cast(date AS string)) AS date",
        f"if({number} % 23 = 0, concat('u', user_id), cast(user_id AS string)) AS user_id",
        "session_id",
        "page_id",
        f"if({number} % 17 = 0, concat(date, ' 10:00:61'),"
        " date_format(action_time, 'yyyy-MM-dd H:mm:ss')) AS action_time",
        "search_keyword",
        "click_category_id",
        "click_product_id",
        "order_category_ids",
        "order_product_ids",
        "pay_category_ids",
        "pay_product_ids",
        "city_id",
    )


def actions_between(
    spark: SparkSession, sf_dir: str, start: dt.date, end: dt.date
) -> DataFrame:
    return tables.action_scan(user_visit_action(spark, sf_dir), start, end)


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        _USERS,
        customer=_read(spark, sf_dir, "customer"),
        nation=_read(spark, sf_dir, "nation"),
    )


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_PRODUCTS, part=_read(spark, sf_dir, "part"))


def blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _read(spark, sf_dir, "customer")
        .where(F.col("c_acctbal") < 0)
        .select(F.col("c_custkey").alias("userid"))
    )


def longer_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blacklist with every third customer added."""
    return (
        _read(spark, sf_dir, "customer")
        .where((F.col("c_acctbal") < 0) | (F.col("c_custkey") % 3 == 0))
        .select(F.col("c_custkey").alias("userid"))
    )


def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as ``id<TAB>k=v|k=v`` lines; every tenth has an empty age."""
    age = F.when(F.col("user_id") % 10 == 0, "").otherwise(F.col("age").cast("string"))
    record = F.concat_ws(
        "|",
        F.concat(F.lit("userid="), "user_id"),
        F.concat(F.lit("age="), age),
        F.concat(F.lit("city="), "city"),
        F.concat(F.lit("sex="), "sex"),
    )
    return user_info(spark, sf_dir).select(
        F.concat_ws("\t", F.col("user_id").cast("string"), record).alias("value")
    )


def ad_lines_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events file, read as a stream, as ad log lines."""
    stream = spark.readStream.schema(_SCHEMAS["events"]).option("pathGlobFilter", "events.parquet")
    return ad_lines(spark, stream.parquet(sf_dir))


def ad_lines(spark: SparkSession, given: DataFrame) -> DataFrame:
    return spark.sql(_AD_LINES, events=given)
