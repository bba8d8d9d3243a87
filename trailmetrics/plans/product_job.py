"""Top products per sales area."""

from __future__ import annotations

from pyspark.sql import DataFrame

from trailmetrics.functions.register import register_functions
from trailmetrics.operators import products
from trailmetrics.params import TaskParams
from trailmetrics.sinks import Sink, register_view, result_table
from trailmetrics.sources.tables import click_scan

# Names of the temporary views for SQL users.
CLICK_VIEW = "tmp_click_product_basic"
COUNT_VIEW = "tmp_area_product_click_count"
FULL_VIEW = "tmp_area_fullprod_click_count"


def area_top3(
    actions: DataFrame, cities: DataFrame, product_info: DataFrame, params: TaskParams
) -> DataFrame:
    clicks = click_scan(actions, params.start_date, params.end_date)
    counts = products.area_product_click_count(clicks, cities)
    return products.area_top3_product(counts, product_info)


def register_views(
    actions: DataFrame, cities: DataFrame, product_info: DataFrame, params: TaskParams
) -> None:
    """The job's steps as temporary views, and the SQL functions to query them with.

    Nothing runs until a view is queried.
    """
    register_functions(actions.sparkSession)
    clicks = click_scan(actions, params.start_date, params.end_date)
    counts = products.area_product_click_count(clicks, cities)
    register_view(products.click_product_basic(clicks, cities), CLICK_VIEW)
    register_view(counts, COUNT_VIEW)
    register_view(products.area_full_product_click_count(counts, product_info), FULL_VIEW)


def run_product_job(
    actions: DataFrame,
    cities: DataFrame,
    product_info: DataFrame,
    params: TaskParams,
    task_id: str,
    sink: Sink,
) -> None:
    name = "area_top3_product"
    top = area_top3(actions, cities, product_info, params)
    sink(result_table(top, name, task_id), name)
