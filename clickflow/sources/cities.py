"""The inline city dimension of the area job."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.sources.literal import local_table
from clickflow.sources.schemas import CITY_AREA

# Fixed values (must equal the original job's dimension): city id, city name, area.
CITY_AREA_ROWS = [
    (0, "北京", "华北"),
    (1, "上海", "华东"),
    (2, "南京", "华东"),
    (3, "广州", "华南"),
    (4, "三亚", "华南"),
    (5, "武汉", "华中"),
    (6, "长沙", "华中"),
    (7, "西安", "西北"),
    (8, "成都", "西南"),
    (9, "哈尔滨", "东北"),
]

# Area → level; any other area is "D_Level".
AREA_LEVELS = [
    ("华北", "A_Level"),
    ("华东", "A_Level"),
    ("华中", "B_Level"),
    ("华南", "B_Level"),
    ("西南", "C_Level"),
    ("西北", "C_Level"),
]
OTHER_AREA_LEVEL = "D_Level"


def city_area_info(spark: SparkSession) -> DataFrame:
    """Ten-row dimension as a literal relation (its row bound is known to the optimizer)."""
    return local_table(spark, CITY_AREA_ROWS, CITY_AREA)


def area_level(area):
    """CASE over the fixed area → level table."""
    expr = None
    for name, level in AREA_LEVELS:
        expr = F.when(area == name, level) if expr is None else expr.when(area == name, level)
    return expr.otherwise(OTHER_AREA_LEVEL)
