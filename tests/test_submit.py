import json

import pytest
from conftest import SF_DIR

import __spark_entry__ as entry_point
import submit
from trailmetrics import sinks
from trailmetrics.schemas import RESULT_COLUMNS
from trailmetrics.sources import star

PARAMS = json.dumps(
    {"startDate": "2024-01-05", "endDate": "2024-01-24", "targetPageFlow": "1,2,3"}
)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    star.user_visit_action(spark, SF_DIR).write.partitionBy("date").parquet(f"{folder}/actions")
    star.user_info(spark, SF_DIR).write.parquet(f"{folder}/users")
    star.product_info(spark, SF_DIR).write.parquet(f"{folder}/products")
    return [
        *("--actions", f"{folder}/actions"),
        *("--users", f"{folder}/users"),
        *("--products", f"{folder}/products"),
    ]


@pytest.mark.parametrize(
    ("job", "tables"),
    [
        (
            "session",
            [
                "session_aggr_stat",
                "session_random_extract",
                "session_detail",
                "top10_category",
                "top10_session",
            ],
        ),
        ("page", ["page_split_convert_rate"]),
        ("product", ["area_top3_product"]),
    ],
)
def test_batch_jobs(spark, stored, tmp_path, job, tables):
    options = ["--sink", "parquet", "--option", f"path={tmp_path}"]
    args = submit.arguments([job, "--params", PARAMS, *stored, *options])
    task_id = submit.run_batch(spark, args)
    for name in tables:
        found = spark.read.parquet(f"{tmp_path}/{name}")
        assert found.columns == ["taskid", *RESULT_COLUMNS[name]]
        assert found.where(found.taskid == task_id).count() == found.count() > 0


def test_stored_tables_give_the_same_top_products(spark, stored, tmp_path):
    whole = json.dumps({"startDate": "2024-01-01", "endDate": "2024-01-31"})
    options = ["--sink", "parquet", "--option", f"path={tmp_path}"]
    submit.run_batch(
        spark, submit.arguments(["product", "--params", whole, *stored, *options])
    )
    found = spark.read.parquet(f"{tmp_path}/area_top3_product").drop("taskid")
    expected = entry_point.area_top3_product(spark, SF_DIR).select(found.columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def test_stream_arguments():
    args = submit.arguments(
        "ads --brokers h:9092 --topics t --blacklist b --output o --checkpoint c"
        " --partitions 400".split()
    )
    assert (args.job, args.partitions) == ("ads", 400)


def test_sessions_from_stored_days_replace_those_of_an_earlier_run(
    spark, stored, scratch, tmp_path
):
    """Both runs have one task id, so one set of rows is left; the second reads daily parts."""
    days = scratch.table("session_days")
    submit.run_days(
        spark, submit.arguments(["days", "--params", PARAMS, *stored[:2], "--session-days", days])
    )
    options = ["--sink", "parquet", "--option", f"path={tmp_path}", "--task-id", "t1", "--replace"]
    given = ["session", "--params", PARAMS, *stored, *options]
    tables = ["session_aggr_stat", "session_random_extract", "session_detail", "top10_session"]

    def run(*more):
        assert submit.run_batch(spark, submit.arguments([*given, *more])) == "t1"
        return {
            name: sorted(
                map(str, sinks.read_results(spark, name, {"path": str(tmp_path)}, "parquet").collect())
            )
            for name in tables
        }

    from_actions = run()
    assert all(from_actions.values())
    assert run("--session-days", days) == from_actions


def test_malformed_actions_go_to_a_table(spark, stored, tmp_path):
    star.text_actions(spark, SF_DIR).write.parquet(f"{tmp_path}/text")
    options = ["--sink", "parquet", "--option", f"path={tmp_path}", "--rejects", "rejects"]
    given = ["product", "--params", PARAMS, *stored, "--actions", f"{tmp_path}/text", *options]
    submit.run_batch(spark, submit.arguments(given))
    rejects = spark.read.parquet(f"{tmp_path}/rejects")
    assert rejects.columns == ["taskid", "raw", "reason"]
    assert rejects.select("reason").distinct().count() == 3
    assert spark.read.parquet(f"{tmp_path}/area_top3_product").count() > 0
