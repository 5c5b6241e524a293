"""The ad-click stream as a chain of Structured Streaming queries on Spark's own state.

The log goes through three hops; each is exactly-once by Spark's checkpoints, state store and file sink:

1. ``filter``: lines are parsed and freed of blacklisted users by an anti join with the blacklist table, and appended to
   ``clean_clicks`` (file sink). ``rejects`` appends the lines that are no clicks to ``rejected_lines``.
2. ``city_counts``, ``trend``, ``province_top3`` and ``recent_hour`` read ``clean_clicks`` as a stream and count with
   ``groupBy`` over event-time windows. Counts live in the state store; a watermark drops the state of windows that ended
   more than ``late`` ago, and clicks that come later than that.
3. ``blacklist`` counts clicks by user, day and ad in the same way, and inserts users above the threshold if absent.

A round runs the hops one after another over what has arrived. The blacklist is read anew at the start of every round and
written only at its end, so a user listed in round n is filtered from round n+1 on. Nothing else is read back but the
blacklist and the few rows of the last top-3: all counts come from the state.

Results: ``clean_clicks``, ``rejected_lines`` and ``recent_hour`` are final rows. ``ad_stat`` and ``ad_click_trend`` hold the
changed totals of each batch under its batch id (``sinks.changes``), which a replayed batch replaces.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickflow.functions.timefmt import DATEKEY_FORMAT
from clickflow.operators import ads as AD
from clickflow.params import TaskParams
from clickflow.sinks import changes as CH
from clickflow.sources import schemas as SC

#: Event time behind the latest click after which a day's or minute's counts are closed, and the same for the sliding hour.
LATE, LATE_IN_HOUR = "2 days", "1 minute"
NOW = {"availableNow": True}

#: Tables that are read before anything may have been written.
TABLES = {
    "clean_clicks": SC.AD_CLICK,
    "rejected_lines": SC.AD_LOG_LINE,
    "blacklist": CH.with_batch(SC.AD_BLACKLIST),
    "ad_stat": CH.with_batch(SC.AD_STAT),
    "ad_click_trend": CH.with_batch(SC.AD_CLICK_TREND),
    "ad_province_top3": CH.with_slot(SC.AD_PROVINCE_TOP3),
    "recent_hour": SC.AD_RECENT_HOUR,
}

STAT_KEYS = ["date", "province", "city", "adid"]
TREND_KEYS = ["date", "hour", "minute", "adid"]


@dataclass
class AdStream:
    """The hops over one set of folders under ``root`` (shared storage), and the readers of their results."""

    spark: SparkSession
    root: str
    params: TaskParams
    late: str = LATE
    late_in_hour: str = LATE_IN_HOUR

    def __post_init__(self) -> None:
        for table, schema in TABLES.items():
            CH.create(self.spark, self.path(table), schema)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _start(self, hop: str, df: DataFrame, trigger: dict, each: Callable[[DataFrame, int], None] | None = None, mode: str = "append") -> StreamingQuery:
        writer = df.writeStream.outputMode(mode).option("checkpointLocation", f"{self.root}/_checkpoints/{hop}").trigger(**trigger)
        if each is not None:
            return writer.foreachBatch(each).start()
        return writer.format("parquet").option("path", self.path(hop)).start()

    # -- hop 1: parse and filter -------------------------------------------------------------------------------

    def start_filter(self, lines: DataFrame, trigger: dict = NOW) -> StreamingQuery:
        """Clicks of users who are not listed now. The blacklist is as it is when the query starts."""
        clicks = AD.not_blacklisted(AD.parse_ad_log(lines), self.blacklist())
        return self._start("clean_clicks", clicks.select(*SC.AD_CLICK.fieldNames()), trigger)

    def start_rejects(self, lines: DataFrame, trigger: dict = NOW) -> StreamingQuery:
        return self._start("rejected_lines", AD.lines_no_clicks(lines), trigger)

    # -- hop 2: counts in Spark's state ------------------------------------------------------------------------

    def _clicks(self, late: str) -> DataFrame:
        clean = self.spark.readStream.schema(SC.AD_CLICK).parquet(self.path("clean_clicks"))
        return clean.withColumn("at", F.timestamp_millis("ts_millis")).withWatermark("at", late)

    def _daily(self, *keys: str) -> DataFrame:
        """Running totals of a day; a batch brings those it changed."""
        counts = self._clicks(self.late).groupBy(F.window("at", "1 day"), *keys).agg(F.count(F.lit(1)).alias("click_count"))
        return counts.select(F.date_format("window.start", DATEKEY_FORMAT).alias("date"), *keys, "click_count")

    def start_city_counts(self, trigger: dict = NOW) -> StreamingQuery:
        counts = self._daily("province", "city", "adid")
        return self._start("ad_stat", counts, trigger, lambda df, n: CH.write(df, n, self.path("ad_stat")), "update")

    def start_trend(self, trigger: dict = NOW) -> StreamingQuery:
        counts = self._clicks(self.late).groupBy(F.window("at", "1 minute"), "adid").agg(F.count(F.lit(1)).alias("click_count"))
        start = F.col("window.start")
        named = counts.select(
            F.date_format(start, DATEKEY_FORMAT).alias("date"), F.date_format(start, "HH").alias("hour"), F.date_format(start, "mm").alias("minute"), "adid", "click_count"
        )
        return self._start("ad_click_trend", named, trigger, lambda df, n: CH.write(df, n, self.path("ad_click_trend")), "update")

    def start_province_top3(self, trigger: dict = NOW) -> StreamingQuery:
        return self._start("ad_province_top3", self._daily("province", "adid"), trigger, self._rank, "update")

    def _rank(self, changed: DataFrame, batch_id: int) -> None:
        """The top 3 after this batch, from the totals it changed and the top 3 before it.

        Totals only grow, so an ad that is neither in the old top 3 nor changed cannot have entered it.
        """
        before = CH.snapshot(self.spark, self.path("ad_province_top3"), SC.AD_PROVINCE_TOP3, batch_id - 1)
        now = changed.select(*before.columns)
        # a changed ad may stand in both: its larger total is the new one
        both = before.unionByName(now).groupBy("date", "province", "adid").agg(F.max("click_count").alias("click_count"))
        CH.write_snapshot(AD.ad_province_top3(both), batch_id, self.path("ad_province_top3"))

    def start_recent_hour(self, trigger: dict = NOW) -> StreamingQuery:
        """Each sliding hour once, when it is over: clicks by minute first, then the hours that hold the minute."""
        clicks = self._clicks(self.late_in_hour)
        per_minute = clicks.groupBy(F.window("at", "1 minute"), "adid").agg(F.count(F.lit(1)).alias("click_count"))
        hours = F.window(F.window_time("window"), f"{AD.WINDOW_MINUTES} minutes", "1 minute")
        return self._start("recent_hour", AD.named_windows(per_minute.groupBy(hours, "adid").agg(F.sum("click_count").alias("click_count"))), trigger)

    # -- hop 3: the blacklist ----------------------------------------------------------------------------------

    def start_blacklist(self, trigger: dict = NOW) -> StreamingQuery:
        return self._start("blacklist", self._daily("userid", "adid"), trigger, self._list_users, "update")

    def _list_users(self, changed: DataFrame, batch_id: int) -> None:
        """Insert the users above the threshold who are not there; a replayed batch inserts the same rows again."""
        over = AD.ad_blacklist(changed, self.params.ad_click_threshold)
        known = self._listed().where(F.col(CH.BATCH) < batch_id)
        CH.write(over.join(known.select("userid"), "userid", "left_anti"), batch_id, self.path("blacklist"))

    # -- rounds ------------------------------------------------------------------------------------------------

    COUNTING = ("city_counts", "trend", "province_top3", "recent_hour")

    def round(self, lines: DataFrame, hops: tuple[str, ...] = COUNTING) -> None:
        """All that has arrived goes through the hops once. A round that failed is taken up where it stopped."""
        first = [self.start_filter(lines), self.start_rejects(lines)]
        _all_done(first)
        _all_done([getattr(self, f"start_{hop}")() for hop in hops])
        _all_done([self.start_blacklist()])

    def run(self, lines: DataFrame, every_seconds: float = 5, rounds: int | None = None) -> None:
        """Rounds every few seconds (for ever if ``rounds`` is None)."""
        done = 0
        while rounds is None or done < rounds:
            began = time.monotonic()
            self.round(lines)
            done += 1
            if rounds is None or done < rounds:
                time.sleep(max(0.0, every_seconds - (time.monotonic() - began)))

    # -- results -----------------------------------------------------------------------------------------------

    def _listed(self) -> DataFrame:
        return self.spark.read.schema(CH.with_batch(SC.AD_BLACKLIST)).parquet(self.path("blacklist"))

    def blacklist(self) -> DataFrame:
        return self._listed().select("userid")

    def clean_clicks(self) -> DataFrame:
        return self.spark.read.schema(SC.AD_CLICK).parquet(self.path("clean_clicks"))

    def rejected_lines(self) -> DataFrame:
        return self.spark.read.schema(SC.AD_LOG_LINE).parquet(self.path("rejected_lines"))

    def city_counts(self) -> DataFrame:
        return CH.latest(self.spark, self.path("ad_stat"), SC.AD_STAT, STAT_KEYS, "click_count")

    def trend(self) -> DataFrame:
        return CH.latest(self.spark, self.path("ad_click_trend"), SC.AD_CLICK_TREND, TREND_KEYS, "click_count")

    def province_top3(self) -> DataFrame:
        return CH.snapshot(self.spark, self.path("ad_province_top3"), SC.AD_PROVINCE_TOP3)

    def recent_hour(self) -> DataFrame:
        return self.spark.read.schema(SC.AD_RECENT_HOUR).parquet(self.path("recent_hour"))


def _all_done(queries: list[StreamingQuery]) -> None:
    for query in queries:
        query.awaitTermination()


def start_parse_stream(lines: DataFrame, out_path: str, checkpoint: str,
                       trigger: dict | None = None) -> StreamingQuery:
    """Parsed clicks appended to a Parquet folder (exactly-once file sink)."""
    return (
        AD.parse_ad_log(lines)
        .writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
