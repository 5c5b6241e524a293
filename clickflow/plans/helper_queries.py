"""Registered queries of the scalar helpers (time, text, key=value records), the
comma-list explode and the session sample; each runs over the whole input tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickflow.functions import text as TX
from clickflow.functions import timefmt as TF
from clickflow.operators import sampling as SM
from clickflow.operators import sessions as S
from clickflow.params import DEFAULT_PARAMS
from clickflow.plans import jobs
from clickflow.plans import oracle_sql as O
from clickflow.plans.ad_queries import clicks
from clickflow.plans.registry import register
from clickflow.sources import testdata as src

P = DEFAULT_PARAMS
PIVOT_TIME = "2024-01-15 12:00:00"


ALL_ACTIONS = "actions AS (SELECT * FROM user_visit_action)"


def _actions(spark, sf_dir):
    return src.load_actions(spark, sf_dir)


@register(
    "time_compare",
    O.with_(ALL_ACTIONS)
    + f" SELECT event_id, action_time, CAST(action_time AS TIMESTAMP) < TIMESTAMP '{PIVOT_TIME}' AS is_before,"
    f" CAST(action_time AS TIMESTAMP) > TIMESTAMP '{PIVOT_TIME}' AS is_after FROM actions",
)
def q_time_compare(spark, sf_dir):
    pivot = F.lit(PIVOT_TIME)
    a = F.col("action_time")
    return _actions(spark, sf_dir).select(
        "event_id", "action_time", TF.before(a, pivot).alias("is_before"), TF.after(a, pivot).alias("is_after")
    )


@register(
    "time_diff_seconds",
    O.with_(ALL_ACTIONS)
    + " SELECT event_id, date_diff('second', CAST(date || ' 00:00:00' AS TIMESTAMP), CAST(action_time AS TIMESTAMP))"
    " AS seconds_of_day FROM actions",
)
def q_time_diff_seconds(spark, sf_dir):
    midnight = F.concat(F.col("date"), F.lit(" 00:00:00"))
    return _actions(spark, sf_dir).select(
        "event_id", TF.minus_seconds(F.col("action_time"), midnight).alias("seconds_of_day")
    )


@register(
    "sessions_by_hour",
    O.with_(ALL_ACTIONS, O.SESSION_SUMMARY_CTE)
    + " SELECT strftime(CAST(start_time AS TIMESTAMP), '%Y-%m-%d_%H') AS date_hour, count(*) AS session_count"
    " FROM summary GROUP BY 1",
)
def q_sessions_by_hour(spark, sf_dir):
    summary = S.session_summary(_actions(spark, sf_dir))
    return summary.groupBy(TF.date_hour(F.col("start_time")).alias("date_hour")).agg(
        F.count(F.lit(1)).alias("session_count")
    )


@register(
    "time_formats",
    O.with_()
    + " SELECT ts_millis, strftime(epoch_ms(ts_millis), '%Y-%m-%d %H:%M:%S') AS event_time,"
    " strftime(epoch_ms(ts_millis), '%Y-%m-%d') AS event_date, date AS date_key,"
    " strftime(epoch_ms(ts_millis), '%Y%m%d%H%M') AS minute_key,"
    " strftime(strptime(date, '%Y%m%d'), '%Y-%m-%d') AS date_from_key FROM ad_click",
)
def q_time_formats(spark, sf_dir):
    ts = TF.millis_to_timestamp(F.col("ts_millis"))
    return clicks(spark, sf_dir).select(
        "ts_millis",
        TF.format_time(ts).alias("event_time"),
        TF.format_date(ts).alias("event_date"),
        F.col("date").alias("date_key"),
        TF.format_minute_key(ts).alias("minute_key"),
        F.date_format(TF.parse_date_key(F.col("date")), TF.DATE_FORMAT).alias("date_from_key"),
    )


@register(
    "string_helpers",
    O.with_(ALL_ACTIONS)
    + " SELECT event_id, (search_keyword IS NULL OR search_keyword = '') AS keyword_missing,"
    " trim(coalesce(order_category_ids, ''), ',') AS order_ids_trimmed,"
    " CASE WHEN city_id < 10 THEN '0' || city_id ELSE CAST(city_id AS VARCHAR) END AS city_code FROM actions",
)
def q_string_helpers(spark, sf_dir):
    ids = F.coalesce("order_category_ids", F.lit(""))
    return _actions(spark, sf_dir).select(
        "event_id",
        TX.is_empty(F.col("search_keyword")).alias("keyword_missing"),
        TX.trim_comma(F.concat(F.lit(","), ids, F.lit(","))).alias("order_ids_trimmed"),
        TX.pad2(F.col("city_id").cast("string")).alias("city_code"),
    )


def _record(summary):
    return F.concat(
        F.lit("sessionid="), F.col("session_id"),
        F.lit("|searchKeywords="), F.col("search_keywords"),
        F.lit("|clickCategoryIds="), F.col("click_category_ids"),
        F.lit("|visitLength="), F.col("visit_length").cast("string"),
        F.lit("|stepLength="), F.col("step_length").cast("string"),
        F.lit("|startTime="), F.col("start_time"),
    )


@register(
    "kv_record_get",
    O.with_(ALL_ACTIONS, O.SESSION_SUMMARY_CTE, f"rec AS (SELECT session_id, {O.RECORD_SQL} AS record FROM summary)")
    + f" SELECT session_id, {O.kv_field_sql('visitLength')} AS visit_length,"
    f" {O.kv_field_sql('searchKeywords')} AS search_keywords FROM rec",
)
def q_kv_record_get(spark, sf_dir):
    rec = S.session_summary(_actions(spark, sf_dir)).select("session_id", _record(None).alias("record"))
    return rec.select(
        "session_id",
        TX.kv_get(F.col("record"), "visitLength").alias("visit_length"),
        TX.kv_get(F.col("record"), "searchKeywords").alias("search_keywords"),
    )


@register(
    "kv_record_set",
    O.with_(ALL_ACTIONS, O.SESSION_SUMMARY_CTE,
            f"rec AS (SELECT session_id, step_length, {O.RECORD_SQL} AS record FROM summary)")
    + " SELECT session_id, regexp_replace(record, '(^|\\|)stepLength=[^|]*',"
    " '\\1stepLength=' || CAST(step_length + 1 AS VARCHAR), 'g') AS record FROM rec",
)
def q_kv_record_set(spark, sf_dir):
    summary = S.session_summary(_actions(spark, sf_dir))
    rec = summary.select("session_id", "step_length", _record(None).alias("record"))
    return rec.select(
        "session_id",
        TX.kv_set(F.col("record"), "stepLength", (F.col("step_length") + 1).cast("string")).alias("record"),
    )


@register(
    "order_categories_exploded",
    O.with_(ALL_ACTIONS)
    + " SELECT event_id, session_id, TRY_CAST(trim(x) AS BIGINT) AS category_id FROM ("
    "SELECT event_id, session_id, unnest(string_split(order_category_ids, ',')) AS x FROM actions"
    " WHERE order_category_ids IS NOT NULL)",
)
def q_order_categories_exploded(spark, sf_dir):
    a = _actions(spark, sf_dir).where(F.col("order_category_ids").isNotNull())
    return a.select(
        "event_id", "session_id", F.explode(TX.comma_list(F.col("order_category_ids"))).alias("x")
    ).select("event_id", "session_id", F.trim("x").try_cast("bigint").alias("category_id"))


_n = P.sample_size
SAMPLE_CTES = (
    "s AS (SELECT *, strftime(CAST(start_time AS TIMESTAMP), '%Y-%m-%d_%H') AS hour FROM filtered)",
    "ph AS (SELECT hour, count(*) AS h FROM s GROUP BY hour)",
    f"q AS (SELECT hour, ({_n} * h + sum(h) OVER () - 1) // sum(h) OVER () AS quota FROM ph)",
    """sample AS (
  SELECT s.session_id, s.start_time, s.search_keywords, s.click_category_ids FROM (
    SELECT *, row_number() OVER (PARTITION BY hour ORDER BY md5(session_id), session_id) AS rn FROM s) s
  JOIN q ON s.hour = q.hour WHERE s.rn <= q.quota
)""",
)


@register(
    "session_sample_hourly",
    O.session_base(P, *SAMPLE_CTES)
    + f" SELECT '{P.task_id}' AS taskid, session_id, start_time, search_keywords, click_category_ids FROM sample",
)
def q_session_sample_hourly(spark, sf_dir):
    return SM.session_sample_hourly(jobs.filtered_sessions(spark, sf_dir, P), P)


@register(
    "session_sample_detail",
    O.session_base(P, *SAMPLE_CTES)
    + f" SELECT '{P.task_id}' AS taskid, " + ", ".join(SM.DETAIL_COLUMNS)
    + " FROM actions WHERE session_id IN (SELECT session_id FROM sample)",
)
def q_session_sample_detail(spark, sf_dir):
    sample = SM.session_sample_hourly(jobs.filtered_sessions(spark, sf_dir, P), P)
    return SM.session_sample_detail(jobs.date_range_actions(spark, sf_dir, P), sample, P)
