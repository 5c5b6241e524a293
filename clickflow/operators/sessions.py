"""Session statistics: summary per session, user join, filters, bucket counts, ratios.

Every function is DataFrame(s) → DataFrame with no action inside. Sessions are built
with one ``groupBy(session_id)`` whose aggregates all merge map-side (min/max/count
and bounded distinct sets), so a session holding a third of all rows still leaves
each task with one partial row for it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.functions.aggregates import group_concat_distinct, join_distinct_numbers
from clickflow.functions.numbers import ratio_half_up
from clickflow.functions.text import is_not_empty
from clickflow.functions.timefmt import format_time, parse_time
from clickflow.params import TaskParams, split_list

# Visit-length buckets in seconds (name, low, high; inclusive, None = open).
# The 1–3 s visits count in their own bucket (the original job added them to 1–3 min).
VISIT_BUCKETS = [
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
]
# Step-length buckets in actions (name, low, high; inclusive, None = open).
STEP_BUCKETS = [
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
]

SUMMARY_COLUMNS = [
    "session_id",
    "user_id",
    "start_time",
    "visit_length",
    "step_length",
    "search_keywords",
    "click_category_ids",
]
USER_COLUMNS = ["age", "professional", "city", "sex"]


def actions_in_date_range(actions: DataFrame, params: TaskParams) -> DataFrame:
    """Inclusive ``yyyy-MM-dd`` range (ISO text order is date order)."""
    return actions.where(F.col("date").between(params.start_date, params.end_date))


def session_summary(actions: DataFrame) -> DataFrame:
    """One row per session: user, start, visit length (s), steps, distinct keywords and
    clicked categories (sorted, comma-joined, exact dedup)."""
    t = parse_time(F.col("action_time"))
    kw = F.col("search_keyword")
    cid = F.col("click_category_id")
    agg = actions.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min(t).alias("_start"),
        F.max(t).alias("_end"),
        F.count(F.lit(1)).alias("step_length"),
        group_concat_distinct(F.when(is_not_empty(kw), kw)).alias("search_keywords"),
        join_distinct_numbers(F.when(cid != -1, cid)).alias("click_category_ids"),
    )
    return agg.select(
        "session_id",
        "user_id",
        format_time(F.col("_start")).alias("start_time"),
        (F.unix_timestamp("_end") - F.unix_timestamp("_start")).alias("visit_length"),
        "step_length",
        "search_keywords",
        "click_category_ids",
    )


def session_full_info(summary: DataFrame, users: DataFrame) -> DataFrame:
    """Session summary ⋈ user_info on user_id (inner: sessions of unknown users drop).

    The join strategy is left to Catalyst/AQE: user_info grows with the data, so it
    is broadcast only when its measured size is under the broadcast threshold.
    """
    return summary.join(users.select("user_id", *USER_COLUMNS), "user_id", "inner").select(
        *SUMMARY_COLUMNS, *USER_COLUMNS
    )


# ---------------------------------------------------------------- filters


def _any_of(column: str, values: list[str], list_column: bool) -> Column:
    c = F.col(column)
    if list_column:
        # Comma-list data: passes when any item equals any parameter value.
        cond = F.arrays_overlap(F.split(c, ","), F.array(*[F.lit(v) for v in values]))
    else:
        cond = c.isin(values)
    return F.coalesce(cond, F.lit(False))


def age_predicate(params: TaskParams) -> Column | None:
    """Inclusive age range, applied only when both bounds are set; null age fails."""
    if params.start_age is None or params.end_age is None:
        return None
    return F.coalesce(F.col("age").between(params.start_age, params.end_age), F.lit(False))


def professional_predicate(params: TaskParams) -> Column | None:
    values = split_list(params.professionals)
    return None if values is None else _any_of("professional", values, False)


def city_predicate(params: TaskParams) -> Column | None:
    values = split_list(params.cities)
    return None if values is None else _any_of("city", values, False)


def sex_predicate(params: TaskParams) -> Column | None:
    if params.sex is None or params.sex == "":
        return None
    return F.coalesce(F.col("sex") == params.sex, F.lit(False))


def keyword_predicate(params: TaskParams) -> Column | None:
    values = split_list(params.keywords)
    return None if values is None else _any_of("search_keywords", values, True)


def category_predicate(params: TaskParams) -> Column | None:
    values = split_list(params.category_ids)
    return None if values is None else _any_of("click_category_ids", values, True)


PREDICATES = [
    age_predicate,
    professional_predicate,
    city_predicate,
    sex_predicate,
    keyword_predicate,
    category_predicate,
]


def session_predicate(params: TaskParams) -> Column | None:
    parts = [p for p in (make(params) for make in PREDICATES) if p is not None]
    return reduce(lambda a, b: a & b, parts) if parts else None


def session_filter(full_info: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions passing all set parameters (unset ones do not restrict)."""
    cond = session_predicate(params)
    return full_info if cond is None else full_info.where(cond)


def filtered_actions(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    """Actions of the surviving sessions (semi join: actions keep their own columns).

    Both sides grow with the data; AQE splits a hot session on the action side.
    """
    return actions.join(sessions.select("session_id"), "session_id", "left_semi")


# ------------------------------------------------------ buckets and ratios


def _in_bucket(c: Column, low: int, high: int | None) -> Column:
    return c >= low if high is None else c.between(low, high)


def _bucket_counts(sessions: DataFrame) -> list[Column]:
    v, s = F.col("visit_length"), F.col("step_length")
    cols = [F.count(F.lit(1)).alias("session_count")]
    cols += [F.count_if(_in_bucket(v, lo, hi)).alias(f"visit_length_{n}") for n, lo, hi in VISIT_BUCKETS]
    cols += [F.count_if(_in_bucket(s, lo, hi)).alias(f"step_length_{n}") for n, lo, hi in STEP_BUCKETS]
    return cols


def bucket_names() -> list[str]:
    return [f"visit_length_{n}" for n, _, _ in VISIT_BUCKETS] + [f"step_length_{n}" for n, _, _ in STEP_BUCKETS]


def session_bucket_counts(sessions: DataFrame) -> DataFrame:
    """One row: session count and the count in each visit / step bucket.

    A global aggregate: each task emits one partial row, the final merge is tiny.
    Visits of 0 s fall in no bucket but count in ``session_count``.
    """
    return sessions.agg(*_bucket_counts(sessions))


def session_ratio(sessions: DataFrame, params: TaskParams) -> DataFrame:
    """``session_aggr_stat``: task id, session count, 15 bucket ratios (2 places, half-up)."""
    counts = session_bucket_counts(sessions)
    total = F.col("session_count")
    return counts.select(
        F.lit(params.task_id).alias("taskid"),
        total,
        *[ratio_half_up(n, "session_count").alias(f"{n}_ratio") for n in bucket_names()],
    )
