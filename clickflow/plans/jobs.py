"""Job-level compositions: the chains the four original programs run, as DataFrames.

Each returns a lazy DataFrame; callers decide the action (write, show, count).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickflow.operators import categories as C
from clickflow.operators import sessions as S
from clickflow.params import TaskParams
from clickflow.sources import testdata as src


def date_range_actions(spark: SparkSession, sf_dir: str, params: TaskParams) -> DataFrame:
    """SRC1: actions in the task's day range (raw ``ts`` range pushed to the scan)."""
    return S.actions_in_date_range(src.load_actions(spark, sf_dir, params), params)


def full_sessions(spark: SparkSession, sf_dir: str, params: TaskParams) -> DataFrame:
    summary = S.session_summary(date_range_actions(spark, sf_dir, params))
    return S.session_full_info(summary, src.load_users(spark, sf_dir))


def filtered_sessions(spark: SparkSession, sf_dir: str, params: TaskParams) -> DataFrame:
    return S.session_filter(full_sessions(spark, sf_dir, params), params)


def filtered_session_actions(spark: SparkSession, sf_dir: str, params: TaskParams) -> DataFrame:
    """Actions of the sessions that pass the task filter (input of the category job)."""
    return S.filtered_actions(date_range_actions(spark, sf_dir, params), filtered_sessions(spark, sf_dir, params))


def filtered_session_counts(spark: SparkSession, sf_dir: str, params: TaskParams) -> DataFrame:
    """Per (session, category) counts of the sessions that pass the task filter."""
    counts = C.session_category_counts(date_range_actions(spark, sf_dir, params))
    return C.counts_of_sessions(counts, filtered_sessions(spark, sf_dir, params))
