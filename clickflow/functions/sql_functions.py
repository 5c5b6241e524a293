"""The two scalar helpers as SQL functions, callable from SQL text over temp views.

SQL functions are inlined by the analyzer (no Python, no opaque UDF). The distinct
concatenation is an aggregate, which a SQL function cannot be: in SQL it is written
``array_join(array_sort(collect_set(x)), ',')``.
"""

from pyspark.sql import SparkSession

SQL_FUNCTIONS = [
    "CREATE OR REPLACE TEMPORARY FUNCTION concat_long_string(v1 BIGINT, v2 STRING, sep STRING) "
    "RETURNS STRING RETURN concat_ws(sep, CAST(v1 AS STRING), v2)",
    "CREATE OR REPLACE TEMPORARY FUNCTION get_json_field(js STRING, field STRING) "
    "RETURNS STRING RETURN get_json_object(js, concat('$.', field))",
]


def register_sql_functions(spark: SparkSession) -> None:
    for stmt in SQL_FUNCTIONS:
        spark.sql(stmt)
