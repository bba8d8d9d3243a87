"""SQL names of the functions that SQL text calls.

They are SQL functions, which Catalyst inlines: calling them adds no Python and
no opaque step to the plan.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_SQL_FUNCTIONS = {
    "concat_long_string(number BIGINT, text STRING, separator STRING)": (
        "concat(cast(number AS STRING), separator, text)"
    ),
    "json_field(document STRING, field STRING)": (
        "get_json_object(document, concat('$.', field))"
    ),
    "date_hour(time TIMESTAMP_NTZ)": "date_format(time, 'yyyy-MM-dd_HH')",
    "trim_comma(text STRING)": "regexp_replace(text, '^,|,$', '')",
    "pad_two(text STRING)": "CASE WHEN length(text) = 2 THEN text ELSE concat('0', text) END",
}

_RETURNS = "STRING"


def register_functions(spark: SparkSession) -> list[str]:
    """Create the temporary SQL functions and return their names.

    The distinct string aggregate needs none: in SQL it is
    ``array_join(array_sort(collect_set(x)), ',')``.
    """
    for signature, body in _SQL_FUNCTIONS.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {_RETURNS} RETURN {body}"
        )
    return [signature.split("(")[0] for signature in _SQL_FUNCTIONS]
