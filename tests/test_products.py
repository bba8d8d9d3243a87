import datetime as dt

import pytest
from conftest import rows

from trailmetrics import schemas
from trailmetrics.operators import products
from trailmetrics.params import TaskParams
from trailmetrics.plans import product_job
from trailmetrics.sources import tables

PARAMS = TaskParams.from_dict({"startDate": "2024-01-01", "endDate": "2024-01-31"})


@pytest.fixture
def shop(spark):
    def build(items, schema):
        return spark.createDataFrame(items, schema)

    return build


def clicks(spark, items):
    return spark.createDataFrame(items, "city_id long, click_product_id long")


def test_cities(spark):
    cities = tables.city_info(spark)
    assert [(f.name, f.dataType) for f in cities.schema] == [
        (f.name, f.dataType) for f in schemas.CITY_INFO
    ]
    assert cities.count() == 10
    assert cities.where("city_id = 9").collect()[0].area == "东北"


def test_click_scan_keeps_real_clicks_of_the_range(actions_of):
    day = dt.datetime
    items = [
        {"click_product_id": 5, "action_time": day(2024, 1, 1)},
        {"click_product_id": 6, "action_time": day(2024, 1, 31, 23, 59, 59)},
        {"click_product_id": -1, "action_time": day(2024, 1, 5)},
        {"click_product_id": None, "action_time": day(2024, 1, 5)},
        {"click_product_id": 7, "action_time": day(2023, 12, 31)},
        {"click_product_id": 8, "action_time": day(2024, 2, 1)},
    ]
    found = tables.click_scan(actions_of(items), PARAMS.start_date, PARAMS.end_date)
    assert sorted(r["click_product_id"] for r in rows(found)) == [5, 6]


def test_city_infos_are_an_exact_set(spark, shop):
    cities = shop([(1, "x", "A"), (11, "x", "A"), (2, "y", "B")], schemas.CITY_INFO)
    found = products.area_product_click_count(
        clicks(spark, [(11, 7), (1, 7), (1, 7), (2, 7), (99, 7)]), cities
    )
    assert rows(found) == [
        {"area": "A", "product_id": 7, "click_count": 3, "city_infos": "11:x,1:x"},
        {"area": "B", "product_id": 7, "click_count": 1, "city_infos": "2:y"},
    ]


@pytest.mark.parametrize(
    ("document", "status"),
    [
        ('{"product_status": 0}', "Self"),
        ('{"product_status": "0"}', "Self"),
        ('{"product_status": 1}', "Third Party"),
        ('{"other": 0}', "Third Party"),
        ("not json", "Third Party"),
        (None, "Third Party"),
    ],
)
def test_product_status(spark, shop, document, status):
    counts = shop([("A", 1, 5, "1:x")], "area string, product_id long, click_count long, city_infos string")
    info = shop([(1, "one", document)], schemas.PRODUCT_INFO)
    full = rows(products.area_full_product_click_count(counts, info))
    assert [r["product_status"] for r in full] == [status]
    assert [r["productStatus"] for r in rows(products.area_top3_product(counts, info))] == [status]


def test_top_three_with_ties_and_unknown_products(spark, shop):
    counts = shop(
        [("华东", p, c, "1:上海") for p, c in [(1, 9), (2, 5), (3, 5), (4, 5), (99, 50)]]
        + [("东北", 1, 1, "9:哈尔滨")],
        "area string, product_id long, click_count long, city_infos string",
    )
    info = shop([(p, f"p{p}", None) for p in range(1, 5)], schemas.PRODUCT_INFO)
    found = rows(products.area_top3_product(counts, info))
    assert [r["productid"] for r in found if r["area"] == "华东"] == [1, 2, 3]
    assert {r["area"]: r["areaLevel"] for r in found} == {"华东": "A Level", "东北": "D Level"}


def test_area_levels(spark):
    areas = ["华东", "华北", "华南", "华中", "西北", "西南", "东北", "其他"]
    df = spark.createDataFrame([(a,) for a in areas], "area string")
    levels = [r[0] for r in df.select(products.area_level(df.area)).collect()]
    assert [level[0] for level in levels] == list("AABBCCDD")


def test_views_for_sql_users(spark, actions_of, shop):
    actions = actions_of(
        [{"click_product_id": 1, "city_id": 0}, {"click_product_id": 1, "city_id": 1}]
    )
    info = shop([(1, "one", '{"product_status": 0}')], schemas.PRODUCT_INFO)
    product_job.register_views(actions, tables.city_info(spark), info, PARAMS)
    assert spark.table("tmp_click_product_basic").count() == 2
    assert spark.table("tmp_area_product_click_count").columns == [
        "area",
        "product_id",
        "click_count",
        "city_infos",
    ]
    found = spark.sql(
        "SELECT area, product_status FROM tmp_area_fullprod_click_count ORDER BY area"
    ).collect()
    assert [tuple(r) for r in found] == [("华东", "Self"), ("华北", "Self")]
