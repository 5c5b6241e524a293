"""Registered streaming runs: the whole ad log of ``sf_dir`` arrives in time slices; after each arrival a round of the
stream's hops takes what is new (``availableNow``, on the same checkpoints and state). Each key runs the hops that its
table needs, on folders of its own. Where the outcome does not depend on batch boundaries, the oracle is the batch query
over the whole input.
"""

from __future__ import annotations

from clickflow.config import shared_dir
from clickflow.params import DEFAULT_PARAMS, TaskParams
from clickflow.plans import oracle_sql as O
from clickflow.plans.ad_queries import recent_hour_sql
from clickflow.plans.registry import register
from clickflow.streaming import ad_stream as AS
from clickflow.streaming.sources import file_lines, slice_bounds, write_ad_log_slice

# Listing threshold of the blacklist runs (see ad_queries) and of the count runs: with
# the default of 10 nobody is listed in the provided data, so the stream's running
# counts must equal the batch counts over all clicks.
LISTING = DEFAULT_PARAMS.with_(ad_click_threshold=2)
COUNTING = DEFAULT_PARAMS
SLICES = 5
BOUNDS = slice_bounds(COUNTING.start_date, COUNTING.end_date, SLICES)


def run_ad_stream(spark, sf_dir: str, params: TaskParams, *hops: str) -> AS.AdStream:
    """The rounds over the time-ordered ad log of ``sf_dir``; the stream's readers give the resulting tables."""
    root = shared_dir(spark, "ad_stream")
    inbox = f"{root}/input"
    stream = AS.AdStream(spark, f"{root}/tables", params)
    for index in range(SLICES):
        write_ad_log_slice(spark, sf_dir, inbox, BOUNDS, index)
        stream.round(file_lines(spark, inbox), hops)
    return stream


@register("stream_ad_log_parse", O.ad_base(2) + " SELECT * FROM ad_click", streaming=True)
def q_stream_ad_log_parse(spark, sf_dir):
    root = shared_dir(spark, "ad_parse")
    inbox = f"{root}/input"
    out = f"{root}/clicks"
    for index in range(SLICES):
        write_ad_log_slice(spark, sf_dir, inbox, BOUNDS, index)
        q = AS.start_parse_stream(file_lines(spark, inbox), out, f"{root}/checkpoint", {"availableNow": True})
        q.awaitTermination()
    return spark.read.parquet(out)


# A user is listed after the first slice in which a running (date, user, ad) count passes
# the threshold; the clicks of that slice still pass, those of later slices do not.
_SLICE_SQL = "0" + "".join(f" + (epoch_ms(ts_millis) >= TIMESTAMP '{b}')::INTEGER" for b in BOUNDS)
BLACKLIST_FILTER_SQL = O.with_(
    f"sliced AS (SELECT *, {_SLICE_SQL} AS slice FROM ad_click)",
    "running AS (SELECT userid, slice, sum(count(*)) OVER (PARTITION BY date, userid, adid ORDER BY slice) AS total"
    " FROM sliced GROUP BY date, userid, adid, slice)",
    f"listed AS (SELECT userid, min(slice) AS slice FROM running WHERE total > {LISTING.ad_click_threshold} GROUP BY userid)",
) + (
    " SELECT s.ts_millis, s.date, s.province, s.city, s.userid, s.adid FROM sliced s"
    " LEFT JOIN listed l ON s.userid = l.userid WHERE l.slice IS NULL OR s.slice <= l.slice"
)


@register("stream_blacklist_filter", BLACKLIST_FILTER_SQL, streaming=True)
def q_stream_blacklist_filter(spark, sf_dir):
    return run_ad_stream(spark, sf_dir, LISTING).clean_clicks()


# Listing is order-free: a user is listed iff some (date, ad) total passes the
# threshold, which is the batch blacklist over the whole input.
@register("stream_blacklist_update", O.ad_base(2) + " SELECT * FROM blacklist", streaming=True)
def q_stream_blacklist_update(spark, sf_dir):
    return run_ad_stream(spark, sf_dir, LISTING).blacklist()


@register("stream_ad_city_count", O.ad_base(10) + " SELECT * FROM city_counts", streaming=True)
def q_stream_ad_city_count(spark, sf_dir):
    return run_ad_stream(spark, sf_dir, COUNTING, "city_counts").city_counts()


@register("stream_ad_province_top3", O.ad_base(10) + " SELECT * FROM province_top3", streaming=True)
def q_stream_ad_province_top3(spark, sf_dir):
    return run_ad_stream(spark, sf_dir, COUNTING, "province_top3").province_top3()


@register("stream_ad_click_trend", O.ad_base(10) + " SELECT * FROM trend", streaming=True)
def q_stream_ad_click_trend(spark, sf_dir):
    return run_ad_stream(spark, sf_dir, COUNTING, "trend").trend()


# The hours that are over: those that end at the last click's time less the lateness of a minute, or earlier.
RECENT_HOUR_SQL = recent_hour_sql(10) + " HAVING (start_m + 60) * 60000 <= (SELECT max(ts_millis) FROM clean) - 60000"


@register("stream_ad_recent_hour", RECENT_HOUR_SQL, streaming=True)
def q_stream_ad_recent_hour(spark, sf_dir):
    return run_ad_stream(spark, sf_dir, COUNTING, "recent_hour").recent_hour()
