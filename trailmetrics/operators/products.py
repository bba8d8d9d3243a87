"""Most clicked products per sales area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmetrics.functions import strings

TOP_PRODUCTS = 3

# The level of each sales area, and of any other area.
AREA_LEVELS = {
    "A Level": ["华东", "华北"],
    "B Level": ["华南", "华中"],
    "C Level": ["西北", "西南"],
}
OTHER_LEVEL = "D Level"


def click_product_basic(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks with their city's name and area; unknown cities drop out."""
    return clicks.join(cities, "city_id").select(
        "city_id", "city_name", "area", F.col("click_product_id").alias("product_id")
    )


def area_product_click_count(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks and cities per area and product.

    Clicks are counted per city and product first. The city join, the text
    building and the set of cities then work on one row per city and product, and
    a product with most of all clicks is no larger than any other.
    """
    per_city = clicks.groupBy("city_id", "click_product_id").agg(F.count("*").alias("clicks"))
    label = strings.concat_long_string(F.col("city_id"), F.col("city_name"))
    return (
        per_city.join(cities, "city_id")
        .groupBy("area", F.col("click_product_id").alias("product_id"))
        .agg(
            F.sum("clicks").alias("click_count"),
            strings.group_concat_distinct(label).alias("city_infos"),
        )
    )


def product_status(extend_info: Column) -> Column:
    is_own = strings.json_field(extend_info, "product_status") == "0"
    return F.when(is_own, "Self").otherwise("Third Party")


def _with_product(counts: DataFrame, products: DataFrame) -> DataFrame:
    return counts.join(products, "product_id")


def area_full_product_click_count(counts: DataFrame, products: DataFrame) -> DataFrame:
    """Counts with the product's name and seller; unknown products drop out."""
    return _with_product(counts, products).select(
        "area",
        "product_id",
        "click_count",
        "city_infos",
        "product_name",
        product_status(F.col("extend_info")).alias("product_status"),
    )


def area_level(area: Column) -> Column:
    level = F.when(F.lit(False), OTHER_LEVEL)
    for name, areas in AREA_LEVELS.items():
        level = level.when(area.isin(areas), name)
    return level.otherwise(OTHER_LEVEL)


def area_top3_product(
    counts: DataFrame, products: DataFrame, n: int = TOP_PRODUCTS
) -> DataFrame:
    """The most clicked products of each area, by clicks and then product id.

    The product's seller is read from its JSON text only for the rows that stay.
    """
    most_clicks = Window.partitionBy("area").orderBy(F.desc("click_count"), F.asc("product_id"))
    return (
        _with_product(counts, products)
        .withColumn("rank", F.row_number().over(most_clicks))
        .where(F.col("rank") <= n)
        .select(
            "area",
            area_level(F.col("area")).alias("areaLevel"),
            F.col("product_id").alias("productid"),
            F.col("city_infos").alias("cityInfos"),
            F.col("click_count").alias("clickCount"),
            F.col("product_name").alias("productName"),
            product_status(F.col("extend_info")).alias("productStatus"),
        )
    )
