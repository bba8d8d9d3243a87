"""Page conversion: the rate of each step of a target page flow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from trailmetrics.operators import pages
from trailmetrics.params import TaskParams
from trailmetrics.sinks import Sink, result_table


def convert_rates(
    actions: DataFrame, flow: Sequence[int], most_in_hour: int | None = None
) -> DataFrame:
    return pages.flow_rates(pages.flow_views(actions, flow, most_in_hour), flow)


def convert_rates_text(
    actions: DataFrame, flow: Sequence[int], most_in_hour: int | None = None
) -> DataFrame:
    return pages.flow_rates_string(pages.flow_views(actions, flow, most_in_hour), flow)


def run_page_job(
    actions: DataFrame,
    params: TaskParams,
    task_id: str,
    sink: Sink,
    most_in_hour: int | None = None,
) -> None:
    """Write the rates. Give `most_in_hour` if times have fractions of a second."""
    name = "page_split_convert_rate"
    rates = convert_rates_text(actions, params.target_page_flow, most_in_hour)
    sink(result_table(rates, name, task_id), name)
