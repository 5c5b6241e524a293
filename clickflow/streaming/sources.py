"""Pluggable line sources for the ad stream (each yields one string column ``value``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.sources import testdata as src
from clickflow.sources.schemas import AD_LOG_LINE


def kafka_lines(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest") -> DataFrame:
    """Kafka topic → lines. Needs the Kafka connector on the classpath (not bundled);
    offsets are tracked in the query checkpoint, not committed to Kafka."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .load()
        .selectExpr("CAST(value AS STRING) AS value")
    )


def file_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Text files in a folder → lines; a batch takes so many new files (None: all)."""
    stream = spark.readStream.schema(AD_LOG_LINE)
    if max_files_per_trigger is not None:
        stream = stream.option("maxFilesPerTrigger", max_files_per_trigger)
    return stream.text(path)


def slice_bounds(start_date: str, end_date: str, slices: int) -> list[dt.datetime]:
    """The inner borders that cut ``start_date..end_date`` into equal slices."""
    lo = dt.datetime.fromisoformat(start_date)
    hi = dt.datetime.fromisoformat(end_date) + dt.timedelta(days=1)
    return [lo + (hi - lo) / slices * i for i in range(1, slices)]


def write_ad_log_slice(spark: SparkSession, sf_dir: str, out_dir: str, bounds: list[dt.datetime], index: int) -> None:
    """Append one time slice of the ad log of ``sf_dir`` to ``out_dir``. The first and
    the last slice are open, so that the slices together hold the whole log."""
    ts = F.col("ts")
    cond = F.lit(True)
    if index > 0:
        cond = cond & (ts >= F.lit(bounds[index - 1]).cast("timestamp_ntz"))
    if index < len(bounds):
        cond = cond & (ts < F.lit(bounds[index]).cast("timestamp_ntz"))
    src.load_ad_log(spark, sf_dir, cond).write.mode("append").text(out_dir)
