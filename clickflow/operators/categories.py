"""Category statistics: click / order / pay counts, top-10 categories, top sessions.

The three counts come from one pass: each action is exploded into (category, kind)
rows and a single conditional aggregate by category replaces the original three
counts and three left joins. Aggregates merge map-side, so hot categories cost one
partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


CLICK, ORDER, PAY = 1, 2, 3
TOP_CATEGORIES = 10
TOP_SESSIONS = 10


def _id_list(text: Column, kind: int) -> Column:
    """Comma list of ids → array<struct<category_id, kind>> (empty when null)."""
    items = F.transform(
        F.split(text, ","),
        lambda x: F.struct(F.trim(x).try_cast("bigint").alias("category_id"), F.lit(kind).alias("kind")),
    )
    return F.coalesce(items, F.array().cast("array<struct<category_id:bigint,kind:int>>"))


def category_events(actions: DataFrame) -> DataFrame:
    """One row per (action, category, kind) over clicks, orders and pays."""
    cid = F.col("click_category_id")
    click = F.when(
        cid != -1, F.array(F.struct(cid.alias("category_id"), F.lit(CLICK).alias("kind")))
    ).otherwise(F.array().cast("array<struct<category_id:bigint,kind:int>>"))
    events = actions.select(
        "session_id",
        F.inline(F.concat(click, _id_list(F.col("order_category_ids"), ORDER), _id_list(F.col("pay_category_ids"), PAY))),
    )
    return events.where(F.col("category_id").isNotNull())


def touched_categories(actions: DataFrame) -> DataFrame:
    """Distinct categories that were clicked, ordered or paid."""
    return category_events(actions).select("category_id").distinct()


def category_click_count(actions: DataFrame) -> DataFrame:
    return (
        actions.where(F.col("click_category_id") != -1)
        .groupBy(F.col("click_category_id").alias("category_id"))
        .agg(F.count(F.lit(1)).alias("click_count"))
    )


def _exploded_count(actions: DataFrame, column: str, kind: int, out: str) -> DataFrame:
    rows = actions.where(F.col(column).isNotNull()).select(F.inline(_id_list(F.col(column), kind)))
    return rows.where(F.col("category_id").isNotNull()).groupBy("category_id").agg(F.count(F.lit(1)).alias(out))


def category_order_count(actions: DataFrame) -> DataFrame:
    return _exploded_count(actions, "order_category_ids", ORDER, "order_count")


def category_pay_count(actions: DataFrame) -> DataFrame:
    return _exploded_count(actions, "pay_category_ids", PAY, "pay_count")


def category_full_count(actions: DataFrame) -> DataFrame:
    """(category_id, click_count, order_count, pay_count), 0 where a kind is absent."""
    k = F.col("kind")
    return category_events(actions).groupBy("category_id").agg(
        F.count_if(k == CLICK).alias("click_count"),
        F.count_if(k == ORDER).alias("order_count"),
        F.count_if(k == PAY).alias("pay_count"),
    )


def top_categories(full_count: DataFrame, n: int = TOP_CATEGORIES) -> DataFrame:
    """Top n by (click, order, pay) descending, ties by category id ascending.

    ``orderBy + limit`` plans as TakeOrderedAndProject: each task keeps its n best.
    """
    return full_count.orderBy(
        F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id")
    ).limit(n)


def actions_in_categories(actions: DataFrame, categories: DataFrame) -> DataFrame:
    """Actions whose clicked category is in ``categories`` (a top-n list: bounded)."""
    top = categories.select(F.col("category_id").alias("click_category_id"))
    return actions.join(top, "click_category_id", "left_semi")


def session_category_counts(actions: DataFrame) -> DataFrame:
    """(session_id, category_id, click_count, order_count, pay_count), zero rows left out.

    Counting comes before any join by session, so a session holding a third of all
    actions reaches the join as one row per category it touched.
    """
    k = F.col("kind")
    return category_events(actions).groupBy("session_id", "category_id").agg(
        F.count_if(k == CLICK).alias("click_count"),
        F.count_if(k == ORDER).alias("order_count"),
        F.count_if(k == PAY).alias("pay_count"),
    )


def counts_of_sessions(counts: DataFrame, sessions: DataFrame) -> DataFrame:
    """The counts of the sessions in ``sessions`` (those that passed the task filter).

    An inner join with distinct ids: a left semi join would be pushed below the counting
    by Catalyst, which puts all actions of a hot session back into one task.
    """
    return counts.join(sessions.select("session_id").distinct(), "session_id")


def full_count_of_sessions(counts: DataFrame) -> DataFrame:
    """``category_full_count`` from per-session counts."""
    return counts.groupBy("category_id").agg(
        *[F.sum(c).alias(c) for c in ("click_count", "order_count", "pay_count")]
    )


def top_sessions_of_counts(counts: DataFrame, categories: DataFrame, n: int = TOP_SESSIONS) -> DataFrame:
    """For each top category, the n sessions with most clicks on it (ties: session id).

    ``row_number() <= n`` lets Catalyst put a partial WindowGroupLimit before the
    shuffle, so each task forwards at most n sessions per category.
    """
    per_session = counts.where(F.col("click_count") > 0).join(categories.select("category_id"), "category_id", "left_semi")
    w = Window.partitionBy("category_id").orderBy(F.desc("click_count"), F.asc("session_id"))
    return (
        per_session.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= n)
        .select("category_id", "session_id", "click_count", "rank")
    )


def top_active_sessions(actions: DataFrame, categories: DataFrame, n: int = TOP_SESSIONS) -> DataFrame:
    """``top_sessions_of_counts`` straight from actions."""
    return top_sessions_of_counts(session_category_counts(actions), categories, n)
