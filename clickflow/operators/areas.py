"""Area statistics: clicked products per area, joined with product info, top 3 per area."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.functions.aggregates import group_concat_distinct
from clickflow.functions.text import concat_long_string, get_json_field
from clickflow.operators.ranking import rank_within_groups
from clickflow.sources.cities import area_level

TOP_PRODUCTS = 3


def city_product_clicks(actions: DataFrame) -> DataFrame:
    """Product clicks as (city_id, click_product_id); only two columns reach the scan."""
    return actions.where(F.col("click_product_id") != -1).select("city_id", "click_product_id")


def area_basic_info(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """Clicks ⋈ city dimension (a literal table of 10 rows, which Spark broadcasts); clicks of unknown cities drop."""
    return clicks.join(cities, "city_id", "inner").select(
        "city_id", "city_name", "area", F.col("click_product_id").alias("pid")
    )


def area_product_click_count(basic: DataFrame) -> DataFrame:
    """(area, pid) → click count and the distinct ``city_id:city_name`` list."""
    return basic.groupBy("area", "pid").agg(
        F.count(F.lit(1)).alias("click_count"),
        group_concat_distinct(concat_long_string(F.col("city_id"), F.col("city_name"), ":")).alias("city_infos"),
    )


def product_status(extend_info) -> F.Column:
    return F.when(get_json_field(extend_info, "product_status") == "0", "Self").otherwise("Third Party")


def area_product_info(counts: DataFrame, products: DataFrame) -> DataFrame:
    """Counts ⋈ product_info (inner). Both sides grow with the data; AQE picks the join."""
    prod = products.select(
        F.col("product_id").alias("pid"), "product_name", product_status(F.col("extend_info")).alias("product_status")
    )
    return counts.join(prod, "pid", "inner").select(
        "area", "city_infos", "pid", "product_name", "product_status", "click_count"
    )


def area_products_sorted(info: DataFrame) -> DataFrame:
    """All rows by click count descending, ties by area and product, with their ``position`` in that order.

    The position is computed apart from the sort (``rank_within_groups`` over one group), so the order can be checked
    and survives a write. The sort itself is range-partitioned.
    """
    placed = rank_within_groups(info, [], [-F.col("click_count"), F.col("area")], "pid", "position")
    return placed.orderBy("position")


def _rank_window():
    return Window.partitionBy("area").orderBy(F.desc("click_count"), F.asc("pid"))


def area_products_ranked(info: DataFrame) -> DataFrame:
    """Every product of an area with its rank (ties by product id).

    No limit applies, so an area is ranked with ``rank_within_groups``: a large area
    is spread over many tasks instead of being sorted by one.
    """
    ranked = rank_within_groups(info, ["area"], [-F.col("click_count")], "pid")
    return ranked.withColumn("rank", F.col("rank").cast("int"))


def area_top3_products(info: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    """Top n products per area with the area level. ``rank <= n`` is a literal
    bound, so Catalyst plans a partial WindowGroupLimit before the shuffle."""
    ranked = info.withColumn("rank", F.row_number().over(_rank_window())).where(F.col("rank") <= n)
    return ranked.select(
        "area",
        area_level(F.col("area")).alias("area_level"),
        "city_infos",
        "pid",
        "product_name",
        "product_status",
        "click_count",
    )


def area_city_list(basic: DataFrame) -> DataFrame:
    """Per area: the distinct clicked cities as one sorted text list."""
    return basic.groupBy("area").agg(
        group_concat_distinct(concat_long_string(F.col("city_id"), F.col("city_name"), ":")).alias("city_infos")
    )
