"""Registered queries of the session-statistics job."""

from __future__ import annotations

from clickflow.params import DEFAULT_PARAMS, TaskParams
from clickflow.plans import jobs
from clickflow.plans import oracle_sql as O
from clickflow.plans.registry import QueryFn, register
from clickflow.operators import sessions as S

P = DEFAULT_PARAMS

# Fixed filter variants (one restriction each, age unset) and the conjunction.
NO_AGE = P.with_(start_age=None, end_age=None)
FILTER_VARIANTS: dict[str, TaskParams] = {
    "session_filter_age": P,
    "session_filter_keywords": NO_AGE.with_(keywords="kw1,kw3"),
    "session_filter_categories": NO_AGE.with_(category_ids="5,40"),
    "session_filter_city": NO_AGE.with_(cities="city3,city7"),
    "session_filter_sex": NO_AGE.with_(sex="male"),
    "session_filter_professional": NO_AGE.with_(professionals="BUILDING,MACHINERY"),
    "session_filter_all": P.with_(
        sex="female",
        professionals="BUILDING,MACHINERY,HOUSEHOLD",
        cities="city1,city2,city3,city5,city7,city8,city10,city12,city15,city20",
        keywords="kw1,kw3,kw5,kw7,kw9",
        category_ids=",".join(str(c) for c in (1, *range(5, 100, 5))),
    ),
}

# ------------------------------------------------------------ session block


# A range inside the days of the events, so that the filter cuts on both sides.
TWO_WEEKS = P.with_(start_date="2024-01-08", end_date="2024-01-21")


@register("actions_in_date_range", O.with_(O.actions_cte(TWO_WEEKS)) + " SELECT * FROM actions")
def q_actions_in_date_range(spark, sf_dir):
    return jobs.date_range_actions(spark, sf_dir, TWO_WEEKS)


@register("session_summary", O.with_(O.actions_cte(P), O.SESSION_SUMMARY_CTE) + " SELECT * FROM summary")
def q_session_summary(spark, sf_dir):
    return S.session_summary(jobs.date_range_actions(spark, sf_dir, P))


@register("session_full_info", O.session_base(P) + " SELECT * FROM full_info")
def q_session_full_info(spark, sf_dir):
    return jobs.full_sessions(spark, sf_dir, P)


def _filter_query(params: TaskParams) -> QueryFn:
    def fn(spark, sf_dir):
        return jobs.filtered_sessions(spark, sf_dir, params)

    return fn


for _name, _params in FILTER_VARIANTS.items():
    register(_name, O.session_base(_params) + " SELECT * FROM filtered")(_filter_query(_params))


_BUCKETS = {f"visit_length_{n}": f"visit_length {c}" for n, c in O.VISIT_BUCKET_SQL.items()}
_BUCKETS |= {f"step_length_{n}": f"step_length {c}" for n, c in O.STEP_BUCKET_SQL.items()}
_BUCKETS_SQL = ",\n".join(f"count(*) FILTER (WHERE {c}) AS {n}" for n, c in _BUCKETS.items())
_BUCKETS_CTE = f"buckets AS (SELECT count(*) AS session_count, {_BUCKETS_SQL} FROM filtered)"


@register("session_bucket_counts", O.session_base(P, _BUCKETS_CTE) + " SELECT * FROM buckets")
def q_session_bucket_counts(spark, sf_dir):
    return S.session_bucket_counts(jobs.filtered_sessions(spark, sf_dir, P))


@register(
    "session_ratio",
    O.session_base(P, _BUCKETS_CTE)
    + f" SELECT '{P.task_id}' AS taskid, session_count, "
    + ", ".join(f"{O.ratio_sql(n, 'session_count')} AS {n}_ratio" for n in _BUCKETS)
    + " FROM buckets",
)
def q_session_ratio(spark, sf_dir):
    return S.session_ratio(jobs.filtered_sessions(spark, sf_dir, P), P)


@register(
    "filtered_actions",
    O.session_base(P) + " SELECT * FROM actions WHERE session_id IN (SELECT session_id FROM filtered)",
)
def q_filtered_actions(spark, sf_dir):
    return jobs.filtered_session_actions(spark, sf_dir, P)
