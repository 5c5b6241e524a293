"""Registered queries of the page-funnel job."""

from __future__ import annotations

from clickflow.operators import funnel as F_
from clickflow.params import DEFAULT_PARAMS
from clickflow.plans import jobs
from clickflow.plans import oracle_sql as O
from clickflow.plans.registry import register

P = DEFAULT_PARAMS


def _transitions(spark, sf_dir):
    return F_.page_transitions(jobs.date_range_actions(spark, sf_dir, P))


@register("page_transitions", O.funnel_base(P) + " SELECT * FROM transitions")
def q_page_transitions(spark, sf_dir):
    return _transitions(spark, sf_dir)


@register("page_pair_count", O.funnel_base(P) + " SELECT * FROM pair_count")
def q_page_pair_count(spark, sf_dir):
    return F_.page_pair_count(_transitions(spark, sf_dir), P)


_first_page = P.page_flow[0]


@register(
    "page_conversion_rate",
    O.funnel_base(
        P,
        f"""steps AS (
  SELECT f.pos, f.from_page_id, f.to_page_id, coalesce(c.pair_count, 0) AS pair_count
  FROM flow f LEFT JOIN pair_count c ON f.from_page_id = c.from_page_id AND f.to_page_id = c.to_page_id
)""",
        f"""prev AS (
  SELECT pos + 1 AS pos, pair_count AS prev_count FROM steps
  UNION ALL
  SELECT 1 AS pos, count(*) AS prev_count FROM actions WHERE page_id = {_first_page}
)""",
    )
    + " SELECT s.pos, s.from_page_id || '_' || s.to_page_id AS pair, s.from_page_id, s.to_page_id, s.pair_count,"
    " p.prev_count, " + O.ratio_sql("s.pair_count", "p.prev_count") + " AS convert_rate"
    " FROM steps s LEFT JOIN prev p ON s.pos = p.pos",
)
def q_page_conversion_rate(spark, sf_dir):
    actions = jobs.date_range_actions(spark, sf_dir, P)
    return F_.page_conversion_rate(actions, F_.page_transitions(actions), P)
