"""Readers for the provided parquet tables and the adapters that turn them into the
click-log model (user_visit_action, user_info, product_info, ad log).

All adapters are narrow projections: no shuffle, and filters on the raw columns stay
pushable to the Parquet scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.config import ensure_session_defaults
from clickflow.params import TaskParams


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_session_defaults(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_events(spark: SparkSession, sf_dir: str, raw_filter: Column | None = None) -> DataFrame:
    """The fact table, with an optional filter on raw columns (pushed to the scan)."""
    events = read_table(spark, sf_dir, "events")
    if raw_filter is not None:
        events = events.where(raw_filter)
    return events


def _event_time(events: DataFrame) -> Column:
    # ``ts`` is timestamp_ntz; as a zoned timestamp in the (UTC) session zone.
    return F.col("ts").cast("timestamp")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def raw_ts_range(start_date: str, end_date: str) -> Column:
    """Inclusive day range as a predicate on the raw ``ts`` column (pushed to Parquet)."""
    lo = dt.datetime.fromisoformat(start_date)
    hi = dt.datetime.fromisoformat(end_date) + dt.timedelta(days=1)
    return (F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz"))


def user_visit_action(events: DataFrame) -> DataFrame:
    """events → user_visit_action. A session is a user-day; seconds of the day are
    divided by 40 so that visit lengths spread over all buckets."""
    t = _event_time(events)
    day = F.unix_timestamp(F.date_trunc("DAY", t))
    k = _k()
    et = F.col("event_type")
    eid = F.col("event_id")
    return events.select(
        F.date_format(t, "yyyy-MM-dd").alias("date"),
        F.col("user_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("_"), F.date_format(t, "yyyyMMdd")).alias("session_id"),
        (eid % 10).alias("page_id"),
        F.date_format(F.timestamp_seconds(day + F.floor((F.unix_timestamp(t) - day) / 40)), "yyyy-MM-dd HH:mm:ss").alias(
            "action_time"
        ),
        F.when(et == "view", F.concat(F.lit("kw"), (k % 10).cast("string"))).alias("search_keyword"),
        F.when(et == "click", k).otherwise(F.lit(-1)).cast("bigint").alias("click_category_id"),
        F.when(et == "click", eid % 100).otherwise(F.lit(-1)).cast("bigint").alias("click_product_id"),
        F.when(et == "signup", F.concat(k.cast("string"), F.lit(","), ((k + 7) % 100).cast("string"))).alias(
            "order_category_ids"
        ),
        F.when(et == "signup", (eid % 100).cast("string")).alias("order_product_ids"),
        F.when(et == "purchase", k.cast("string")).alias("pay_category_ids"),
        F.when(et == "purchase", (eid % 100).cast("string")).alias("pay_product_ids"),
        (eid % 12).alias("city_id"),
        eid.alias("event_id"),
    )


def load_actions(spark: SparkSession, sf_dir: str, params: TaskParams | None = None) -> DataFrame:
    """user_visit_action, with the task's day range pushed to the raw scan when given."""
    cond = raw_ts_range(params.start_date, params.end_date) if params is not None else None
    return user_visit_action(read_events(spark, sf_dir, cond))


def user_info(customer: DataFrame) -> DataFrame:
    c = F.col("c_custkey")
    return customer.select(
        c.alias("user_id"),
        F.concat(F.lit("user"), c.cast("string")).alias("username"),
        F.col("c_name").alias("name"),
        ((c * 7) % 60).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.concat(F.lit("city"), F.col("c_nationkey").cast("string")).alias("city"),
        F.when(c % 2 == 0, "male").otherwise("female").alias("sex"),
    )


def load_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_info(read_table(spark, sf_dir, "customer"))


def product_info(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit('{"product_status": '), (F.col("p_size") % 2).cast("string"), F.lit("}")).alias("extend_info"),
    )


def load_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_info(read_table(spark, sf_dir, "part"))


def ad_log(events: DataFrame) -> DataFrame:
    """events → ad log lines ``epoch_millis province city userid adid`` (column ``value``)."""
    t = _event_time(events)
    u = F.col("user_id")
    return events.select(
        F.concat_ws(
            " ",
            F.unix_millis(t).cast("string"),
            (u % 10).cast("string"),
            (u % 10).cast("string"),
            u.cast("string"),
            (_k() % 20).cast("string"),
        ).alias("value")
    )


def load_ad_log(spark: SparkSession, sf_dir: str, raw_filter: Column | None = None) -> DataFrame:
    return ad_log(read_events(spark, sf_dir, raw_filter))
