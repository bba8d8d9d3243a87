"""Each registered query against DuckDB on the same tables."""

from dataclasses import replace

import pytest
from conftest import SF_DIR, oracle_of, rows, same
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from trailmetrics.operators import sampling, sessions
from trailmetrics.params import TaskParams
from trailmetrics.plans import session_job
from trailmetrics.sources import star

QUERIES = entry_point.shop_queries()
ORACLES = entry_point.shop_oracles()


def test_every_query_has_anoracle_of():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(name, spark, duck):
    assert same(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) > 0


def test_entry(spark):
    result = rows(entry_point.entry(spark))
    assert len(result) == 21
    assert {row["productStatus"] for row in result} <= {"Self", "Third Party"}


def _range(start, end, **values):
    return TaskParams.from_dict(
        {"startDate": start, "endDate": end, "startAge": 20, "endAge": 50, **values}
    )


def _found(spark, params):
    actions = star.actions_between(spark, SF_DIR, params.start_date, params.end_date)
    return actions, sessions.filtered_sessions(actions, star.user_info(spark, SF_DIR), params)


@pytest.mark.parametrize(("start", "end"), [("2024-01-10", "2024-01-11"), ("2024-01-12",) * 2])
def test_sample_of_few_days_has_larger_quotas(spark, duck, scratch, start, end):
    oracle = oracle_of(start, end)
    actions, found = _found(spark, _range(start, end))
    quotas = sampling.session_extract_quota(sampling.session_hour_count(found))
    same(quotas, duck, oracle["session_extract_quota"])
    assert max(row["quota"] for row in rows(quotas)) > 2
    sample = session_job.session_sample(found, actions, scratch, seed=3)
    same(sample, duck, oracle["session_random_extract"])
    detail = session_job.sample_detail(actions, sample)
    same(detail, duck, oracle["session_random_extract_detail"])


@pytest.mark.parametrize(
    "flow", [[1, 1, 2], [5], [2, 3, 2, 3], [9, 0, 4], [7, 7, 7, 8], list(range(10))]
)
def test_page_flows(spark, duck, flow):
    from trailmetrics.operators import pages
    from trailmetrics.plans import page_job

    params = _range("2024-01-01", "2024-01-31")
    actions = star.actions_between(spark, SF_DIR, params.start_date, params.end_date)
    if len(flow) == 1:
        assert rows(page_job.convert_rates(actions, flow)) == []
        assert rows(page_job.convert_rates_text(actions, flow)) == [{"convertRate": ""}]
        return
    oracle = oracle_of("2024-01-01", "2024-01-31", flow=flow)
    by_step = pages.page_split_pairs(actions, flow).groupBy(
        "session_id", "action_time", "page_split"
    )
    same(by_step.agg(F.sum("pairs").alias("pairs")), duck, oracle["page_split_pairs"])
    same(page_job.convert_rates(actions, flow), duck, oracle["page_convert_rate"])
    same(page_job.convert_rates_text(actions, flow), duck, oracle["page_convert_rate_string"])


def test_lean_and_full_filters_agree(spark):
    params = _range(
        "2024-01-01",
        "2024-01-31",
        keywords="kw1,kw4",
        categoryIds="3,5,9",
        professionals="BUILDING,MACHINERY",
        sex="male",
    )
    actions, lean = _found(spark, params)
    full = sessions.session_filter(
        sessions.session_aggregate(actions, star.user_info(spark, SF_DIR)), params
    )
    columns = ["session_id", "user_id", "start_time", "visit_length", "step_length"]
    assert rows(lean.select(columns)) == rows(full.select(columns))
    assert lean.count() > 0


def test_the_large_sample_has_different_quotas(spark):
    quotas = entry_point.session_extract_quota_large(spark, SF_DIR)
    found = {row["quota"] for row in rows(quotas)}
    assert min(found) == 1 and max(found) >= 5


def test_each_of_the_six_filters_leaves_sessions_out(spark):
    kept = entry_point.filtered_sessions_all(spark, SF_DIR).count()
    for name in ("start_age", "professionals", "cities", "sex", "keywords", "category_ids"):
        without = replace(entry_point.ALL_FILTERS, **{name: None if name in ("start_age", "sex") else ()})
        _, found = _found(spark, without)
        assert found.count() > kept > 0, name
