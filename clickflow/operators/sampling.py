"""Session sampling (declared output of the session job, no code in the original).

Rule: every ``yyyy-MM-dd_HH`` of session start gets a quota of
``ceil(n · hour_sessions / all_sessions)`` sessions, taken in ``md5(session_id)``
order, so that any engine draws the same sample.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.functions.timefmt import date_hour
from clickflow.params import TaskParams


def session_sample_hourly(sessions: DataFrame, params: TaskParams) -> DataFrame:
    n = params.sample_size
    with_hour = sessions.withColumn("hour", date_hour(F.col("start_time")))
    per_hour = with_hour.groupBy("hour").agg(F.count(F.lit(1)).alias("hour_sessions"))
    # One row per hour: the total over this small table is a bounded window.
    quotas = per_hour.select(
        "hour",
        F.expr(f"({n} * hour_sessions + sum(hour_sessions) OVER () - 1) div sum(hour_sessions) OVER ()").alias("quota"),
    )
    w = Window.partitionBy("hour").orderBy(F.md5("session_id"), "session_id")
    # A quota never exceeds n, so the literal bound lets Catalyst cut each hour to n
    # rows per task (partial WindowGroupLimit) before the shuffle.
    ranked = with_hour.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
    picked = ranked.join(quotas, "hour", "inner").where(F.col("rn") <= F.col("quota"))
    return picked.select(
        F.lit(params.task_id).alias("taskid"),
        "session_id",
        "start_time",
        "search_keywords",
        "click_category_ids",
    )


DETAIL_COLUMNS = [
    "user_id",
    "session_id",
    "page_id",
    "action_time",
    "search_keyword",
    "click_category_id",
    "click_product_id",
    "order_category_ids",
    "order_product_ids",
    "pay_category_ids",
    "pay_product_ids",
]


def session_sample_detail(actions: DataFrame, sample: DataFrame, params: TaskParams) -> DataFrame:
    """All actions of the sampled sessions (the sample is small; AQE measures it)."""
    picked = actions.join(sample.select("session_id"), "session_id", "left_semi")
    return picked.select(F.lit(params.task_id).alias("taskid"), *DETAIL_COLUMNS)
