"""Registered queries of the ad statistics (batch form) and of the result-table merges.

Batch semantics of the blacklist: users whose (date, user, ad) count over the whole
input exceeds the threshold; their clicks are left out of every later statistic.
The merge keys compare an "old" stored table (events up to 2024-01-20) with a "new"
batch (events from 2024-01-11): keys overlap on ten days and each side keeps its own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from clickflow.operators import ads as AD
from clickflow.params import DEFAULT_PARAMS
from clickflow.plans import oracle_sql as O
from clickflow.plans.registry import register
from clickflow.sinks import merge as M
from clickflow.sources import testdata as src

# Fixed parameter of the registered ad keys: max (date, user, ad) count is 3–4 in
# the provided data, so the default of 10 would list nobody.
ADS = DEFAULT_PARAMS.with_(ad_click_threshold=2)
T = ADS.ad_click_threshold

OLD_BEFORE = dt.datetime(2024, 1, 21)
NEW_FROM = dt.datetime(2024, 1, 11)
OLD_SQL = "< TIMESTAMP '2024-01-21 00:00:00'"
NEW_SQL = ">= TIMESTAMP '2024-01-11 00:00:00'"


def _ntz(d: dt.datetime):
    return F.lit(d).cast("timestamp_ntz")


def clicks(spark, sf_dir, raw_filter=None):
    return AD.parse_ad_log(src.load_ad_log(spark, sf_dir, raw_filter))


def old_clicks(spark, sf_dir):
    return clicks(spark, sf_dir, F.col("ts") < _ntz(OLD_BEFORE))


def new_clicks(spark, sf_dir):
    return clicks(spark, sf_dir, F.col("ts") >= _ntz(NEW_FROM))


def blacklist(spark, sf_dir, threshold: int = T):
    return AD.ad_blacklist(AD.ad_user_click_count(clicks(spark, sf_dir)), threshold)


def clean_clicks(spark, sf_dir, threshold: int = T):
    return AD.not_blacklisted(clicks(spark, sf_dir), blacklist(spark, sf_dir, threshold))


def _city(spark, sf_dir):
    return AD.ad_city_count(clean_clicks(spark, sf_dir))


@register("ad_log_parse", O.ad_base(T) + " SELECT * FROM ad_click")
def q_ad_log_parse(spark, sf_dir):
    return clicks(spark, sf_dir)


@register("ad_user_click_count", O.ad_base(T) + " SELECT * FROM user_counts")
def q_ad_user_click_count(spark, sf_dir):
    return AD.ad_user_click_count(clicks(spark, sf_dir))


@register("ad_blacklist", O.ad_base(T) + " SELECT * FROM blacklist")
def q_ad_blacklist(spark, sf_dir):
    return blacklist(spark, sf_dir)


@register("ad_clicks_not_blacklisted", O.ad_base(T) + " SELECT * FROM clean")
def q_ad_clicks_not_blacklisted(spark, sf_dir):
    return clean_clicks(spark, sf_dir)


@register("ad_city_count", O.ad_base(T) + " SELECT * FROM city_counts")
def q_ad_city_count(spark, sf_dir):
    return _city(spark, sf_dir)


@register("ad_province_count", O.ad_base(T) + " SELECT * FROM province_counts")
def q_ad_province_count(spark, sf_dir):
    return AD.ad_province_click_count(clean_clicks(spark, sf_dir))


@register("ad_province_top3", O.ad_base(T) + " SELECT * FROM province_top3")
def q_ad_province_top3(spark, sf_dir):
    return AD.ad_province_top3(AD.ad_province_click_count(clean_clicks(spark, sf_dir)))


@register("ad_click_trend", O.ad_base(T) + " SELECT * FROM trend")
def q_ad_click_trend(spark, sf_dir):
    return AD.ad_click_trend(clean_clicks(spark, sf_dir))


def recent_hour_sql(threshold: int) -> str:
    return O.ad_base(
        threshold,
        "per_minute AS (SELECT ts_millis // 60000 AS m, adid, count(*) AS c FROM clean GROUP BY ALL)",
        "fanned AS (SELECT m - i AS start_m, adid, c FROM per_minute CROSS JOIN range(0, 60) AS r(i))",
    ) + (
        " SELECT strftime(make_timestamp(start_m * 60000000), '%Y-%m-%d %H:%M') AS window_start,"
        " strftime(make_timestamp((start_m + 60) * 60000000), '%Y-%m-%d %H:%M') AS window_end,"
        " adid, CAST(sum(c) AS BIGINT) AS click_count FROM fanned GROUP BY start_m, adid"
    )


@register("ad_recent_hour", recent_hour_sql(T))
def q_ad_recent_hour(spark, sf_dir):
    return AD.ad_recent_hour(clean_clicks(spark, sf_dir))


# ------------------------------------------------------------- merges (sinks)

NO_LIST = 10**9  # the merge fixtures are unfiltered statistics of each slice


def _slices(threshold: int = NO_LIST, *extra: str) -> str:
    return O.with_(
        *O.ad_slice("old_", OLD_SQL, threshold), *O.ad_slice("new_", NEW_SQL, threshold), *extra
    )


@register(
    "ad_click_count_lookup",
    _slices()
    + " SELECT n.date, n.userid, n.adid, n.click_count, coalesce(o.click_count, 0) AS stored_count"
    " FROM new_user_counts n LEFT JOIN old_user_counts o ON n.date = o.date AND n.userid = o.userid AND n.adid = o.adid",
)
def q_ad_click_count_lookup(spark, sf_dir):
    return AD.click_count_lookup(AD.ad_user_click_count(new_clicks(spark, sf_dir)),
                                 AD.ad_user_click_count(old_clicks(spark, sf_dir)))


@register(
    "upsert_accumulate",
    _slices()
    + " SELECT date, userid, adid, CAST(sum(click_count) AS BIGINT) AS click_count FROM ("
    "SELECT * FROM old_user_counts UNION ALL SELECT * FROM new_user_counts) GROUP BY ALL",
)
def q_upsert_accumulate(spark, sf_dir):
    keys = ["date", "userid", "adid"]
    return M.upsert_accumulate(AD.ad_user_click_count(old_clicks(spark, sf_dir)),
                               AD.ad_user_click_count(new_clicks(spark, sf_dir)), keys)


@register(
    "upsert_overwrite",
    _slices()
    + " SELECT * FROM new_city_counts UNION ALL SELECT * FROM old_city_counts o WHERE NOT EXISTS ("
    "SELECT 1 FROM new_city_counts n WHERE n.date = o.date AND n.province = o.province AND n.city = o.city"
    " AND n.adid = o.adid)",
)
def q_upsert_overwrite(spark, sf_dir):
    keys = ["date", "province", "city", "adid"]
    return M.upsert_overwrite(AD.ad_city_count(old_clicks(spark, sf_dir)), AD.ad_city_count(new_clicks(spark, sf_dir)),
                              keys)


@register(
    "upsert_overwrite_trend",
    _slices()
    + " SELECT * FROM new_trend UNION ALL SELECT * FROM old_trend o WHERE NOT EXISTS ("
    "SELECT 1 FROM new_trend n WHERE n.date = o.date AND n.hour = o.hour AND n.minute = o.minute AND n.adid = o.adid)",
)
def q_upsert_overwrite_trend(spark, sf_dir):
    keys = ["date", "hour", "minute", "adid"]
    return M.upsert_overwrite(AD.ad_click_trend(old_clicks(spark, sf_dir)), AD.ad_click_trend(new_clicks(spark, sf_dir)),
                              keys)


@register(
    "replace_groups",
    _slices()
    + " SELECT * FROM new_province_top3 UNION ALL SELECT * FROM old_province_top3 o WHERE NOT EXISTS ("
    "SELECT 1 FROM new_province_top3 n WHERE n.date = o.date AND n.province = o.province)",
)
def q_replace_groups(spark, sf_dir):
    def top3(c):
        return AD.ad_province_top3(AD.ad_province_click_count(c))

    return M.replace_groups(top3(old_clicks(spark, sf_dir)), top3(new_clicks(spark, sf_dir)), ["date", "province"])


@register(
    "blacklist_insert_new",
    _slices(T)
    + " SELECT userid FROM old_blacklist UNION ALL SELECT userid FROM new_blacklist"
    " WHERE userid NOT IN (SELECT userid FROM old_blacklist)",
)
def q_blacklist_insert_new(spark, sf_dir):
    old = AD.ad_blacklist(AD.ad_user_click_count(old_clicks(spark, sf_dir)), T)
    new = AD.ad_blacklist(AD.ad_user_click_count(new_clicks(spark, sf_dir)), T)
    return M.insert_new(old, new, ["userid"])
