"""Explicit schemas of the input and output tables."""

from pyspark.sql import types as T

USER_VISIT_ACTION = T.StructType(
    [
        T.StructField("date", T.StringType()),  # yyyy-MM-dd
        T.StructField("user_id", T.LongType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("action_time", T.StringType()),  # yyyy-MM-dd HH:mm:ss
        T.StructField("search_keyword", T.StringType()),  # null: no search
        T.StructField("click_category_id", T.LongType()),  # -1: no click
        T.StructField("click_product_id", T.LongType()),  # -1: no click
        T.StructField("order_category_ids", T.StringType()),  # comma list, null: no order
        T.StructField("order_product_ids", T.StringType()),
        T.StructField("pay_category_ids", T.StringType()),  # comma list, null: no pay
        T.StructField("pay_product_ids", T.StringType()),
        T.StructField("city_id", T.LongType()),
        T.StructField("event_id", T.LongType()),  # extra: deterministic tie-break
    ]
)

USER_INFO = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("username", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("professional", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("sex", T.StringType()),
    ]
)

PRODUCT_INFO = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("extend_info", T.StringType()),  # JSON text
    ]
)

CITY_AREA = T.StructType(
    [
        T.StructField("city_id", T.LongType()),
        T.StructField("city_name", T.StringType()),
        T.StructField("area", T.StringType()),
    ]
)

# One ad click: "epoch_millis province city userid adid", space separated.
AD_LOG_LINE = T.StructType([T.StructField("value", T.StringType())])

AD_CLICK = T.StructType(
    [
        T.StructField("ts_millis", T.LongType()),
        T.StructField("date", T.StringType()),  # yyyyMMdd
        T.StructField("province", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("userid", T.LongType()),
        T.StructField("adid", T.LongType()),
    ]
)

# Stored result tables (the "old" side of every upsert).
AD_BLACKLIST = T.StructType([T.StructField("userid", T.LongType())])
AD_USER_CLICK_COUNT = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("userid", T.LongType()),
        T.StructField("adid", T.LongType()),
        T.StructField("click_count", T.LongType()),
    ]
)
AD_STAT = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("province", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("adid", T.LongType()),
        T.StructField("click_count", T.LongType()),
    ]
)
AD_PROVINCE_TOP3 = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("province", T.StringType()),
        T.StructField("adid", T.LongType()),
        T.StructField("click_count", T.LongType()),
    ]
)
AD_CLICK_TREND = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("hour", T.StringType()),
        T.StructField("minute", T.StringType()),
        T.StructField("adid", T.LongType()),
        T.StructField("click_count", T.LongType()),
    ]
)
AD_RECENT_HOUR = T.StructType(
    [
        T.StructField("window_start", T.StringType()),  # yyyy-MM-dd HH:mm
        T.StructField("window_end", T.StringType()),
        T.StructField("adid", T.LongType()),
        T.StructField("click_count", T.LongType()),
    ]
)
