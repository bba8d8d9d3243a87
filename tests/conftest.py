import datetime as dt
import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import oracle_queries  # noqa: E402
from trailmetrics import schemas  # noqa: E402
from trailmetrics.runtime import Scratch  # noqa: E402

SF_DIR = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    """Intermediate tables, deleted after the test."""
    tables = Scratch(spark, "test")
    yield tables
    tables.close()


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def rows(df):
    """The rows as dicts, in an order of their own."""
    return sorted(
        (row.asDict() for row in df.collect()),
        key=lambda row: [(value is not None, str(value)) for value in row.values()],
    )


def duck_rows(connection, sql):
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    return names, result.fetchall()


def same(df, connection, sql):
    """Spark's rows and DuckDB's are equal, as bags, with the same columns."""
    names, expected = duck_rows(connection, sql)
    assert sorted(names) == sorted(df.columns)
    actual = [tuple(row) for row in df.select(*names).collect()]
    assert sorted(map(repr, actual)) == sorted(map(repr, expected))
    return len(actual)


@pytest.fixture(scope="session")
def actions_of(spark):
    """Build typed actions from dicts; what a dict leaves out has a plain value."""

    def build(items):
        defaults = {
            "date": None,
            "user_id": 1,
            "session_id": "s1",
            "page_id": 1,
            "action_time": dt.datetime(2024, 1, 5, 10),
            "search_keyword": None,
            "click_category_id": -1,
            "click_product_id": -1,
            "order_category_ids": None,
            "order_product_ids": None,
            "pay_category_ids": None,
            "pay_product_ids": None,
            "city_id": 0,
        }
        full = []
        for item in items:
            row = {**defaults, **item}
            row["date"] = row["date"] or row["action_time"].date()
            full.append(tuple(row[name] for name in schemas.USER_VISIT_ACTION.names))
        return spark.createDataFrame(full, schemas.USER_VISIT_ACTION)

    return build


@pytest.fixture(scope="session")
def users_of(spark):
    def build(items):
        defaults = {
            "user_id": 1,
            "username": "u",
            "name": "n",
            "age": 30,
            "professional": "p1",
            "city": "c1",
            "sex": "male",
        }
        full = [tuple({**defaults, **item}[n] for n in schemas.USER_INFO.names) for item in items]
        return spark.createDataFrame(full, schemas.USER_INFO)

    return build


def at(seconds, day=5, hour=10):
    return dt.datetime(2024, 1, day, hour) + dt.timedelta(seconds=seconds)


def oracle_of(start, end, **changes):
    """The clickstream results in DuckDB SQL, for other parameters than the registered ones."""
    values = {
        "start": start,
        "end": end,
        "scan": (start, end),
        "ages": (20, 50),
        "keywords": ["kw1"],
        "flow": [1, 2, 3],
        "seed": 3,
        **changes,
    }
    return oracle_queries.build(**values)
