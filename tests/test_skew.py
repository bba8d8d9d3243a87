"""Each query against DuckDB on tables where one session holds a third of all actions."""

import shutil

import duckdb
import pytest
from conftest import SF_DIR, oracle_of, same
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from trailmetrics.plans import page_job
from trailmetrics.sources import star

QUERIES = entry_point.shop_queries()
ORACLES = entry_point.shop_oracles()
NAMES = [name for name in QUERIES if not name.startswith(("scalar", "kv"))]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The tables, with every third event moved to one day of one user."""
    folder = tmp_path_factory.mktemp("skewed")
    for name in ("customer", "nation", "part"):
        shutil.copy(f"{SF_DIR}/{name}.parquet", folder / f"{name}.parquet")
    busy = star.user_info(spark, SF_DIR).where("age between 20 and 50").agg(F.min("user_id"))
    user = busy.collect()[0][0]
    connection = duckdb.connect()
    connection.execute(
        f"""
        COPY (
          SELECT event_id,
                 CASE WHEN event_id % 3 = 0
                      THEN TIMESTAMP '2024-01-10' + (ts - date_trunc('day', ts)) ELSE ts END AS ts,
                 CASE WHEN event_id % 3 = 0 THEN {user} ELSE user_id END AS user_id,
                 event_type, value, props
          FROM '{SF_DIR}/events.parquet'
        ) TO '{folder}/events.parquet' (FORMAT parquet)
        """
    )
    for name in ("customer", "nation", "part", "events"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return str(folder), connection


def test_the_session_is_there(spark, skewed):
    folder, _ = skewed
    counts = star.user_visit_action(spark, folder).groupBy("session_id").count()
    assert counts.agg(F.max("count")).first()[0] * 3 >= 10_000


@pytest.mark.parametrize("name", NAMES)
def test_query(name, spark, skewed):
    folder, connection = skewed
    assert same(QUERIES[name](spark, folder), connection, ORACLES[name]) > 0


@pytest.mark.parametrize("flow", [[1, 1, 2], [7, 7, 7, 8], list(range(10))])
def test_flows(spark, skewed, flow):
    folder, connection = skewed
    actions = star.user_visit_action(spark, folder)
    oracle = oracle_of("2024-01-01", "2024-01-31", flow=flow)
    same(page_job.convert_rates(actions, flow), connection, oracle["page_convert_rate"])
