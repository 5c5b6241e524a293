"""Ad-click statistics over parsed ad logs (batch form; the stream reuses these).

All counts are ``groupBy`` aggregates with map-side partial aggregation, so a hot
user, ad or province costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.functions.timefmt import DATEKEY_FORMAT, MINUTE_KEY_FORMAT

TOP_ADS = 3
WINDOW_MINUTES = 60


# Epoch milliseconds of the years 1 to 9999, which date keys can name.
FIRST_MILLIS, LAST_MILLIS = -62_135_596_800_000, 253_402_300_799_999


def _field(i: int) -> Column:
    return F.get("parts", F.lit(i))


def _number(i: int) -> Column:
    return _field(i).try_cast("bigint")


def _parted(lines: DataFrame, column: str) -> DataFrame:
    """Each line with its parts. The line is split once: what stands above the generator reads its column, and no filter
    is pushed below it."""
    return lines.select(F.col(column).alias("line"), F.explode(F.array(F.split(F.col(column), " ", -1))).alias("parts"))


def _is_click() -> Column:
    good = _number(0).between(FIRST_MILLIS, LAST_MILLIS) & _number(3).isNotNull() & _number(4).isNotNull()
    return F.coalesce(good, F.lit(False))


def parse_ad_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """``epoch_millis province city userid adid`` → typed columns.

    Ids and time are any Long; further fields are ignored. Lines without five fields, with an id or time that is no
    number, or with a time outside the years 1 to 9999 are no clicks: see ``lines_no_clicks``.
    """
    millis = _number(0)
    return _parted(lines, column).where(_is_click()).select(
        millis.alias("ts_millis"),
        F.date_format(F.timestamp_millis(millis), DATEKEY_FORMAT).alias("date"),
        _field(1).alias("province"),
        _field(2).alias("city"),
        _number(3).alias("userid"),
        _number(4).alias("adid"),
    )


def lines_no_clicks(lines: DataFrame, column: str = "value") -> DataFrame:
    """The lines that ``parse_ad_log`` leaves out, as they are: (value)."""
    return _parted(lines, column).where(~_is_click()).select(F.col("line").alias("value"))


def rejected_ad_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """The lines that ``parse_ad_log`` leaves out, each with how often it occurs: (line, occurrences)."""
    bad = lines_no_clicks(lines, column).select(F.col("value").alias("line"))
    return bad.groupBy("line").agg(F.count(F.lit(1)).alias("occurrences"))


def _count() -> Column:
    return F.count(F.lit(1)).alias("click_count")


def ad_user_click_count(clicks: DataFrame) -> DataFrame:
    """(date, userid, adid) → clicks."""
    return clicks.groupBy("date", "userid", "adid").agg(_count())


def ad_blacklist(user_counts: DataFrame, threshold: int) -> DataFrame:
    """Users with a (date, user, ad) count strictly above ``threshold``."""
    return user_counts.where(F.col("click_count") > threshold).select("userid").distinct()


def not_blacklisted(clicks: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Clicks of users not in the blacklist. The blacklist grows with the user base,
    so the join strategy (broadcast or shuffle) is left to AQE's size check."""
    return clicks.join(blacklist.select("userid"), "userid", "left_anti")


def ad_city_count(clicks: DataFrame) -> DataFrame:
    """(date, province, city, adid) → clicks."""
    return clicks.groupBy("date", "province", "city", "adid").agg(_count())


def ad_province_count(city_counts: DataFrame) -> DataFrame:
    """Roll the city counts up to (date, province, adid) (the stream keeps city totals)."""
    return city_counts.groupBy("date", "province", "adid").agg(F.sum("click_count").alias("click_count"))


def ad_province_click_count(clicks: DataFrame) -> DataFrame:
    """(date, province, adid) → clicks, counted directly: equal to the roll-up of the
    city counts, with one aggregation instead of two."""
    return clicks.groupBy("date", "province", "adid").agg(_count())


def ad_province_top3(province_counts: DataFrame, n: int = TOP_ADS) -> DataFrame:
    """Top n ads per (date, province) by clicks, ties by ad id (partial
    WindowGroupLimit before the shuffle)."""
    w = Window.partitionBy("date", "province").orderBy(F.desc("click_count"), F.asc("adid"))
    return (
        province_counts.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= n)
        .select("date", "province", "adid", "click_count")
    )


def ad_click_trend(clicks: DataFrame) -> DataFrame:
    """Clicks per (event minute, ad) as (date yyyyMMdd, hour HH, minute mm, adid)."""
    key = F.date_format(F.timestamp_millis(F.col("ts_millis")), MINUTE_KEY_FORMAT)
    keyed = clicks.select(
        key.substr(1, 8).alias("date"), key.substr(9, 2).alias("hour"), key.substr(11, 2).alias("minute"), "adid"
    )
    return keyed.groupBy("date", "hour", "minute", "adid").agg(_count())


def named_windows(counts: DataFrame) -> DataFrame:
    """(window, adid, click_count) with the window's ends as text."""
    ends = (F.date_format(f"window.{end}", "yyyy-MM-dd HH:mm").alias(f"window_{end}") for end in ("start", "end"))
    return counts.select(*ends, "adid", "click_count")


def ad_recent_hour(clicks: DataFrame, minutes: int = WINDOW_MINUTES) -> DataFrame:
    """Clicks of every ad in every window of ``minutes`` minutes, slide 1 minute, that holds one.

    Clicks are counted by minute first. A minute's count c enters the windows that start ``minutes`` - 1 minutes before it
    and leaves them one minute after it, so each count is two steps, +c and -c, and a window's clicks are the sum of the
    steps up to its start. Sums run inside blocks of ``minutes`` starts: a count's two steps lie in neighbouring blocks, and
    the later block gets what is open at its first start as a step of its own. So the network carries at most three rows
    for each count instead of ``minutes``; the windows between two steps are filled in after it.
    """
    minute = F.expr("(ts_millis - pmod(ts_millis, 60000)) div 60000")
    per_minute = clicks.groupBy(minute.alias("m"), "adid").agg(_count())
    first, gone, c = F.col("m") - (minutes - 1), F.col("m") + 1, F.col("click_count")
    block = lambda at: F.floor(at / minutes)
    step = lambda at, change: F.struct(block(at).alias("block"), at.alias("at"), change.alias("change"))
    # the first start is the first of its block only if the second step opens the next block
    steps = F.when(first % minutes == 0, F.array(step(first, c))).otherwise(F.array(step(first, c), step(block(gone) * minutes, c), step(gone, -c)))
    rows = per_minute.select("adid", F.inline(steps))
    at_once = rows.repartition("adid", "block").groupBy("adid", "block", "at").agg(F.sum("change").alias("change"))
    inside = Window.partitionBy("adid", "block").orderBy("at")
    so_far = F.sum("change").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = (F.col("block") + 1) * minutes
    runs = at_once.select("adid", "at", so_far.alias("click_count"), F.coalesce(F.lead("at").over(inside), last).alias("until"))
    starts = runs.where("click_count > 0").select("adid", "click_count", F.explode(F.sequence(F.col("at"), F.col("until") - 1)).alias("start"))
    fmt = "yyyy-MM-dd HH:mm"
    return starts.select(
        F.date_format(F.timestamp_seconds(F.col("start") * 60), fmt).alias("window_start"),
        F.date_format(F.timestamp_seconds((F.col("start") + minutes) * 60), fmt).alias("window_end"),
        "adid",
        "click_count",
    )


def click_count_lookup(batch_counts: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored total for each (date, userid, adid) of a batch, 0 when absent (set-based
    replacement of one point lookup per record)."""
    s = stored.select("date", "userid", "adid", F.col("click_count").alias("stored_count"))
    return batch_counts.join(s, ["date", "userid", "adid"], "left").select(
        "date", "userid", "adid", "click_count", F.coalesce("stored_count", F.lit(0).cast("bigint")).alias("stored_count")
    )
