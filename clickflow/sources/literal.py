"""Small fixed tables as SQL ``VALUES`` relations.

A ``VALUES`` relation is a LocalRelation: the optimizer knows its size, so it
broadcasts it by its own size check, while a
``createDataFrame`` of Python rows is an opaque RDD scan of unknown size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    names = schema.fieldNames()
    if not rows:
        return spark.createDataFrame([], schema)
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
    df = spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
