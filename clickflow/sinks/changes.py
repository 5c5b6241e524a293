"""Sinks of streaming batches in update mode: a batch writes under its own id, so a replay replaces what it wrote.

``write`` appends the rows a batch changed; ``latest`` is the table that they add up to. ``write_snapshot`` keeps a small
table whole: batches take turns in two slots, so the snapshot before stays readable while the next one is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.sinks.writers import write_partitioned

BATCH, SLOT = "batch_id", "slot"


def with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])


def with_slot(schema: T.StructType) -> T.StructType:
    return T.StructType([*with_batch(schema).fields, T.StructField(SLOT, T.IntegerType())])


def create(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """A folder that can be read, without any file, if there is none yet."""
    # a partitioned write of no rows makes no part file
    spark.createDataFrame([], schema).withColumn("__none", F.lit(0)).write.mode("ignore").partitionBy("__none").parquet(path)


def write(rows: DataFrame, batch_id: int, path: str) -> None:
    write_partitioned(rows.withColumn(BATCH, F.lit(batch_id).cast("bigint")), path, [BATCH])


def latest(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], value: str) -> DataFrame:
    """Of each key the value of the last batch that changed it."""
    rows = spark.read.schema(with_batch(schema)).parquet(path)
    return rows.groupBy(*keys).agg(F.max_by(value, BATCH).alias(value)).select(*schema.fieldNames())


def write_snapshot(rows: DataFrame, batch_id: int, path: str) -> None:
    rows.withColumn(BATCH, F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{path}/{SLOT}={batch_id % 2}")


def snapshot(spark: SparkSession, path: str, schema: T.StructType, batch_id: int | None = None) -> DataFrame:
    """The snapshot of a batch, or the last one."""
    rows = spark.read.schema(with_slot(schema)).parquet(path)
    if batch_id is not None:
        rows = rows.where((F.col(SLOT) == abs(batch_id) % 2) & (F.col(BATCH) == batch_id))
    else:
        rows = rows.join(F.broadcast(rows.agg(F.max(BATCH).alias(BATCH))), BATCH)
    return rows.select(*schema.fieldNames())
