"""Batch tables: user actions, users, products and cities."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmetrics import schemas
from trailmetrics.functions import dates, ids
from trailmetrics.runtime import Scratch

# The shop's cities with their sales areas.
CITIES = [
    (0, "北京", "华北"),
    (1, "上海", "华东"),
    (2, "南京", "华东"),
    (3, "广州", "华南"),
    (4, "三亚", "华南"),
    (5, "武汉", "华中"),
    (6, "长沙", "华中"),
    (7, "西安", "西北"),
    (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
]


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a parquet path if the name holds a ``/``."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def read_split(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a bucketed table as plain files, of which several tasks read one."""
    stored = spark.table(name)
    return spark.read.schema(stored.schema).parquet(*stored.inputFiles())


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns, casting where the stored type differs."""
    stored = {field.name: field.dataType for field in df.schema.fields}

    def column(field: T.StructField) -> Column:
        source = F.col(field.name)
        if stored[field.name] == field.dataType:
            return source
        if isinstance(field.dataType, T.TimestampNTZType) and isinstance(
            stored[field.name], T.StringType
        ):
            source = dates.parse_time(source)
        return source.cast(field.dataType).alias(field.name)

    return df.select([column(field) for field in schema.fields])


def _in_range(df: DataFrame, start: dt.date, end: dt.date) -> Column:
    """Inclusive range on ``date``, in the stored type so that it prunes the scan."""
    stored = df.schema["date"].dataType
    if isinstance(stored, T.StringType):
        return F.col("date").between(start.isoformat(), end.isoformat())
    if isinstance(stored, T.TimestampType | T.TimestampNTZType):
        # The last day counts up to its end.
        after = end + dt.timedelta(days=1)
        return (F.col("date") >= F.lit(start).cast(stored)) & (
            F.col("date") < F.lit(after).cast(stored)
        )
    return F.col("date").between(F.lit(start), F.lit(end))


def action_scan(actions: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Actions of the days from start to end, both included.

    Takes the stored form, where dates and times may be text, and returns the
    typed form. Store the table partitioned by ``date`` to read only those days.
    """
    return _conform(actions.where(_in_range(actions, start, end)), schemas.USER_VISIT_ACTION)


def _tried(df: DataFrame, schema: T.StructType) -> dict[str, Column]:
    """The schema's columns, null where a stored value has another form."""
    stored = {field.name: field.dataType for field in df.schema.fields}

    def column(field: T.StructField) -> Column:
        source = F.col(field.name)
        if isinstance(field.dataType, T.TimestampNTZType) and isinstance(
            stored[field.name], T.StringType
        ):
            return dates.try_parse_time(source)
        return source if stored[field.name] == field.dataType else source.try_cast(field.dataType)

    return {field.name: column(field) for field in schema.fields}


def checked_scan(
    actions: DataFrame, start: dt.date, end: dt.date, scratch: Scratch
) -> tuple[DataFrame, DataFrame]:
    """What `action_scan` returns, without rows that it would stop at, and those rows.

    The second table has the row as it is stored, as JSON (`raw`), and the first
    column that is not what it should be (`reason`). Rows of other days are in
    neither; a row whose day is malformed is of no day and always rejected. Both
    come from one scan, which writes them down; each is read by itself.
    """
    typed = _tried(actions, schemas.USER_VISIT_ACTION)
    reason = F.coalesce(
        *[
            F.when(
                F.col(name).isNotNull() & value.isNull(),
                f"{name} is not a {schemas.USER_VISIT_ACTION[name].dataType.simpleString()}",
            )
            for name, value in typed.items()
        ]
    )
    wanted = _in_range(actions, start, end)
    if isinstance(actions.schema["date"].dataType, T.StringType):
        wanted = wanted | (F.col("date").isNotNull() & typed["date"].isNull())
    raw = F.to_json(F.struct("*"))
    checked = actions.where(wanted).select(
        *[value.alias(name) for name, value in typed.items()],
        reason.alias("reason"),
        F.when(reason.isNotNull(), raw).alias("raw"),
        reason.isNotNull().alias("rejected"),
    )
    written = scratch.write(checked, "checked_actions", partition_by=["rejected"])
    return (
        written.where(~F.col("rejected")).select(*schemas.USER_VISIT_ACTION.names),
        written.where("rejected").select("raw", "reason"),
    )


def read_actions(spark: SparkSession, name: str, start: dt.date, end: dt.date) -> DataFrame:
    return action_scan(read_table(spark, name), start, end)


def read_users(spark: SparkSession, name: str = "user_info") -> DataFrame:
    return _conform(read_table(spark, name), schemas.USER_INFO)


def read_products(spark: SparkSession, name: str = "product_info") -> DataFrame:
    return _conform(read_table(spark, name), schemas.PRODUCT_INFO)


def city_info(spark: SparkSession) -> DataFrame:
    """The fixed cities as an inline table, whose size Spark knows when it plans joins."""
    rows = ", ".join(f"({city_id}L, '{name}', '{area}')" for city_id, name, area in CITIES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS city_info(city_id, city_name, area)")


def click_scan(actions: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """City and product of the real clicks in the date range."""
    return actions.where(
        _in_range(actions, start, end) & ids.is_click(F.col("click_product_id"))
    ).select("city_id", "click_product_id")
