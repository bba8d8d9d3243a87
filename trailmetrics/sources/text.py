"""Text lines of the form ``id<TAB>key=value|key=value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmetrics.functions import strings


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def record_lines(lines: DataFrame) -> DataFrame:
    """The id and the key-value record of each line that has both."""
    parts = F.split("value", "\t")
    return lines.where(F.size(parts) >= 2).select(
        parts[0].alias("id"), parts[1].alias("record")
    )


def record_field(records: DataFrame, field: str) -> DataFrame:
    """Id and value of one field, for the records that hold it."""
    return records.select("id", strings.get_field(F.col("record"), "|", field).alias(field)).where(
        F.col(field).isNotNull()
    )
