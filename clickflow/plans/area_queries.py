"""Registered queries of the area top-3 job."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickflow.functions.sql_functions import register_sql_functions
from clickflow.functions.text import get_json_field
from clickflow.operators import areas as A
from clickflow.params import DEFAULT_PARAMS
from clickflow.plans import jobs
from clickflow.plans import oracle_sql as O
from clickflow.plans.registry import register
from clickflow.sources import testdata as src
from clickflow.sources.cities import city_area_info

P = DEFAULT_PARAMS


def _basic(spark, sf_dir):
    clicks = A.city_product_clicks(jobs.date_range_actions(spark, sf_dir, P))
    return A.area_basic_info(clicks, city_area_info(spark))


def _info(spark, sf_dir):
    return A.area_product_info(A.area_product_click_count(_basic(spark, sf_dir)), src.load_products(spark, sf_dir))


@register("city_product_clicks", O.area_base(P) + " SELECT * FROM clicks")
def q_city_product_clicks(spark, sf_dir):
    return A.city_product_clicks(jobs.date_range_actions(spark, sf_dir, P))


@register("area_basic_info", O.area_base(P) + " SELECT * FROM basic")
def q_area_basic_info(spark, sf_dir):
    return _basic(spark, sf_dir)


@register("area_product_click_count", O.area_base(P) + " SELECT * FROM area_count")
def q_area_product_click_count(spark, sf_dir):
    return A.area_product_click_count(_basic(spark, sf_dir))


@register(
    "group_concat_distinct",
    O.area_base(P)
    + " SELECT area, coalesce(array_to_string(list_sort(list_distinct(list(city_id || ':' || city_name))), ','), '')"
    " AS city_infos FROM basic GROUP BY area",
)
def q_group_concat_distinct(spark, sf_dir):
    return A.area_city_list(_basic(spark, sf_dir))


@register("area_product_info", O.area_base(P) + " SELECT * FROM area_info")
def q_area_product_info(spark, sf_dir):
    return _info(spark, sf_dir)


# The same statistics as a user of SQL writes them: temp views and the registered functions.
AREA_INFO_BY_SQL = """
WITH counted AS (
  SELECT area, click_product_id AS product_id, count(*) AS clicks,
         collect_set(concat_long_string(city_id, city_name, ':')) AS cities
  FROM area_clicks JOIN area_cities USING (city_id)
  GROUP BY area, click_product_id
)
SELECT area, array_join(array_sort(cities), ',') AS city_infos, product_id AS pid, product_name,
       if(get_json_field(extend_info, 'product_status') = '0', 'Self', 'Third Party') AS product_status, clicks AS click_count
FROM counted JOIN area_products USING (product_id)
"""


@register("area_product_info_sql", O.area_base(P) + " SELECT * FROM area_info")
def q_area_product_info_sql(spark, sf_dir):
    register_sql_functions(spark)
    A.city_product_clicks(jobs.date_range_actions(spark, sf_dir, P)).createOrReplaceTempView("area_clicks")
    city_area_info(spark).createOrReplaceTempView("area_cities")
    src.load_products(spark, sf_dir).createOrReplaceTempView("area_products")
    return spark.sql(AREA_INFO_BY_SQL)


@register("area_products_sorted", O.area_base(P) + " SELECT *, row_number() OVER (ORDER BY click_count DESC, area, pid) AS position FROM area_info")
def q_area_products_sorted(spark, sf_dir):
    return A.area_products_sorted(_info(spark, sf_dir))


@register("area_products_ranked", O.area_base(P) + " SELECT * FROM area_ranked")
def q_area_products_ranked(spark, sf_dir):
    return A.area_products_ranked(_info(spark, sf_dir))


@register(
    "area_top3_products",
    O.area_base(P)
    + f" SELECT area, {O.AREA_LEVEL_CASE} AS area_level, city_infos, pid, product_name, product_status, click_count"
    " FROM area_ranked WHERE rank <= 3",
)
def q_area_top3_products(spark, sf_dir):
    return A.area_top3_products(_info(spark, sf_dir))


@register(
    "json_field",
    O.with_() + " SELECT product_id, json_extract_string(extend_info, '$.product_status') AS product_status"
    " FROM product_info",
)
def q_json_field(spark, sf_dir):
    products = src.load_products(spark, sf_dir)
    return products.select("product_id", get_json_field(F.col("extend_info"), "product_status").alias("product_status"))
