"""Scalar helpers and the distinct-concat aggregate on hand-made rows."""

from pyspark.sql import functions as F

from clickflow.functions import text as TX
from clickflow.functions import timefmt as TF
from clickflow.functions.aggregates import group_concat_distinct
from clickflow.params import TaskParams, split_list


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr).first()[0]


def test_trim_comma(spark):
    c = F.col("s")
    assert one(spark, TX.trim_comma(c), ",a,b,") == "a,b"
    assert one(spark, TX.trim_comma(c), "a,b") == "a,b"  # unchanged, not emptied
    assert one(spark, TX.trim_comma(c), ",a") == "a"


def test_pad2_and_empty(spark):
    c = F.col("s")
    assert one(spark, TX.pad2(c), "5") == "05"
    assert one(spark, TX.pad2(c), "12") == "12"
    assert one(spark, TX.pad2(c), "123") == "123"
    assert one(spark, TX.is_empty(c), "") is True
    assert one(spark, TX.is_empty(c), None) is True
    assert one(spark, TX.is_not_empty(c), "x") is True


def test_kv_get(spark):
    c = F.col("s")
    rec = "sessionid=a|visitLength=12|empty=|stepLength=3=4|stepLength=5|x=1=|startTime=2024-01-01 00:00:00"
    assert one(spark, TX.kv_get(c, "visitLength"), rec) == "12"
    assert one(spark, TX.kv_get(c, "empty"), rec) is None
    # A segment with two '=' is skipped; the next one with the field counts.
    assert one(spark, TX.kv_get(c, "stepLength"), rec) == "5"
    assert one(spark, TX.kv_get(c, "x"), rec) == "1"  # trailing '=' dropped as by a split
    assert one(spark, TX.kv_get(c, "startTime"), rec) == "2024-01-01 00:00:00"
    assert one(spark, TX.kv_get(c, "missing"), rec) is None


def test_kv_get_with_a_long_delimiter(spark):
    c = F.col("s")
    rec = "a=1|x||b=2||c=||d=3=4||d=5"
    assert [one(spark, TX.kv_get(c, f, "||"), rec) for f in "abcd"] == ["1|x", "2", None, "5"]
    assert one(spark, TX.kv_get(c, "b", ".*"), "a=1.*b=2") == "2"
    assert one(spark, TX.kv_get(c, "a"), None) is None


def test_today_and_yesterday(spark):
    import datetime as dt

    day, before = spark.range(1).select(TF.today(), TF.yesterday()).first()
    assert day - before == dt.timedelta(days=1)
    assert abs(day - dt.datetime.now(dt.timezone.utc).date()) <= dt.timedelta(days=1)


def test_kv_set(spark):
    c = F.col("s")
    assert one(spark, TX.kv_set(c, "b", "9"), "a=1|b=2|c=3") == "a=1|b=9|c=3"
    assert one(spark, TX.kv_set(c, "z", "9"), "a=1|b=2") == "a=1|b=2"  # never adds
    assert one(spark, TX.kv_set(c, "b", ""), "a=1|b=2") == "a=1|b="  # empty allowed
    assert one(spark, TX.kv_set(c, "b", "9"), "bb=1|b=2") == "bb=1|b=9"


def test_group_concat_distinct_exact(spark):
    df = spark.createDataFrame([("1:x",), ("11:x",), ("1:x",), (None,)], "s string")
    # Exact dedup (no substring loss), binary text order: "11:x" < "1:x" since "1" < ":".
    assert df.agg(group_concat_distinct(F.col("s"))).first()[0] == "11:x,1:x"


def test_time_helpers(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05", "2024-01-02 03:03:00")], "a string, b string")
    r = df.select(
        TF.before(F.col("b"), F.col("a")).alias("before"),
        TF.after(F.col("b"), F.col("a")).alias("after"),
        TF.minus_seconds(F.col("a"), F.col("b")).alias("diff"),
        TF.date_hour(F.col("a")).alias("dh"),
        TF.format_date_key(TF.parse_time(F.col("a"))).alias("dk"),
        TF.format_minute_key(TF.parse_time(F.col("a"))).alias("mk"),
        F.date_format(TF.parse_date_key(F.lit("20240102")), "yyyy-MM-dd").alias("pd"),
    ).first()
    assert (r.before, r.after, r.diff, r.dh, r.dk, r.mk, r.pd) == (
        True, False, 65, "2024-01-02_03", "20240102", "202401020304", "2024-01-02",
    )


def test_parse_time_accepts_unpadded_fields(spark):
    df = spark.createDataFrame([("2024-01-01 5:03:02", "2024-01-01 05:03:01")], "a string, b string")
    r = df.select(TF.minus_seconds(F.col("a"), F.col("b")).alias("d"), TF.date_hour(F.col("a")).alias("h")).first()
    assert (r.d, r.h) == (1, "2024-01-01_05")


def test_params():
    assert split_list("") is None and split_list(None) is None
    assert split_list("a, b,,c") == ["a", "b", "c"]
    p = TaskParams(target_page_flow="1,2,3,4")
    assert p.page_pairs == [(1, 1, 2), (2, 2, 3), (3, 3, 4)]
    assert TaskParams(target_page_flow="5").page_pairs == []
