"""Registered queries of the category statistics (top-10 categories and sessions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickflow.operators import categories as C
from clickflow.params import DEFAULT_PARAMS
from clickflow.plans import jobs
from clickflow.plans import oracle_sql as O
from clickflow.plans.registry import register

P = DEFAULT_PARAMS


def _with_task(df):
    """Prefix the task id, as in the declared top-10 output tables."""
    return df.select(F.lit(P.task_id).alias("taskid"), *df.columns)


def _fa(spark, sf_dir):
    return jobs.filtered_session_actions(spark, sf_dir, P)


def _counts(spark, sf_dir):
    return jobs.filtered_session_counts(spark, sf_dir, P)


@register("touched_categories", O.category_base(P) + " SELECT DISTINCT category_id FROM cat_events")
def q_touched_categories(spark, sf_dir):
    return C.touched_categories(_fa(spark, sf_dir))


@register(
    "category_click_count",
    O.category_base(P) + " SELECT click_category_id AS category_id, count(*) AS click_count FROM fa"
    " WHERE click_category_id <> -1 GROUP BY click_category_id",
)
def q_category_click_count(spark, sf_dir):
    return C.category_click_count(_fa(spark, sf_dir))


@register(
    "category_order_count",
    O.category_base(P) + " SELECT category_id, count(*) AS order_count FROM cat_events WHERE kind = 2 GROUP BY 1",
)
def q_category_order_count(spark, sf_dir):
    return C.category_order_count(_fa(spark, sf_dir))


@register(
    "category_pay_count",
    O.category_base(P) + " SELECT category_id, count(*) AS pay_count FROM cat_events WHERE kind = 3 GROUP BY 1",
)
def q_category_pay_count(spark, sf_dir):
    return C.category_pay_count(_fa(spark, sf_dir))


@register("category_full_count", O.category_base(P) + " SELECT * FROM full_count")
def q_category_full_count(spark, sf_dir):
    return C.full_count_of_sessions(_counts(spark, sf_dir))


@register("top10_categories", O.category_base(P) + f" SELECT '{P.task_id}' AS taskid, * FROM top10")
def q_top10_categories(spark, sf_dir):
    return _with_task(C.top_categories(C.full_count_of_sessions(_counts(spark, sf_dir))))


@register(
    "actions_in_top10_categories",
    O.category_base(P) + " SELECT * FROM fa WHERE click_category_id IN (SELECT category_id FROM top10)",
)
def q_actions_in_top10_categories(spark, sf_dir):
    fa = _fa(spark, sf_dir)
    return C.actions_in_categories(fa, C.top_categories(C.category_full_count(fa)))


@register(
    "top10_active_sessions",
    O.category_base(
        P,
        """per_session AS (
  SELECT click_category_id AS category_id, session_id, count(*) AS click_count FROM fa
  WHERE click_category_id IN (SELECT category_id FROM top10) GROUP BY 1, 2
)""",
    )
    + f" SELECT '{P.task_id}' AS taskid, category_id, session_id, click_count, rank FROM ("
    "SELECT *, CAST(row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id ASC) AS INTEGER)"
    " AS rank FROM per_session) WHERE rank <= 10",
)
def q_top10_active_sessions(spark, sf_dir):
    counts = _counts(spark, sf_dir)
    return _with_task(C.top_sessions_of_counts(counts, C.top_categories(C.full_count_of_sessions(counts))))
