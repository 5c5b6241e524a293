"""Merge forms (properties), table sinks, and the ad stream (state, replay, expiry, blacklist)."""

import datetime as dt
import random
from pathlib import Path

from pyspark.sql import functions as F

from clickflow.config import shared_dir
from clickflow.operators import ads as AD
from clickflow.params import TaskParams
from clickflow.plans import programs as PG
from clickflow.sinks import merge as M
from clickflow.sinks.writers import replace_table, write_partitioned
from clickflow.sources.schemas import AD_STAT
from clickflow.streaming import ad_stream as AS
from clickflow.streaming.sources import file_lines
from conftest import rows

KEYS = ["date", "province", "city", "adid"]


def stat(spark, data):
    return spark.createDataFrame(data, AD_STAT)


def test_upsert_accumulate_is_order_free(spark):
    a = stat(spark, [("d", "p", "c", 1, 2), ("d", "p", "c", 2, 1)])
    b = stat(spark, [("d", "p", "c", 1, 5), ("d", "p", "x", 1, 1)])
    ab, ba = M.upsert_accumulate(a, b, KEYS), M.upsert_accumulate(b, a, KEYS)
    assert rows(ab) == rows(ba) == [("d", "p", "c", 1, 7), ("d", "p", "c", 2, 1), ("d", "p", "x", 1, 1)]


def test_upsert_overwrite_is_idempotent(spark):
    old = stat(spark, [("d", "p", "c", 1, 2), ("d", "p", "c", 2, 1)])
    new = stat(spark, [("d", "p", "c", 1, 5)])
    once = M.upsert_overwrite(old, new, KEYS)
    assert rows(once) == [("d", "p", "c", 1, 5), ("d", "p", "c", 2, 1)]
    assert rows(M.upsert_overwrite(once, new, KEYS)) == rows(once)


def test_replace_groups_and_insert_new(spark):
    old = spark.createDataFrame([("d", "p1", 1, 5), ("d", "p1", 2, 4), ("d", "p2", 1, 3)], "date string, province string, adid long, click_count long")
    new = spark.createDataFrame([("d", "p1", 3, 9)], old.schema)
    assert rows(M.replace_groups(old, new, ["date", "province"])) == [("d", "p1", 3, 9), ("d", "p2", 1, 3)]
    a = spark.createDataFrame([(1,), (2,)], "userid long")
    b = spark.createDataFrame([(2,), (3,), (3,)], "userid long")
    assert rows(M.insert_new(a, b, ["userid"])) == [(1,), (2,), (3,)]


def test_replace_table(spark):
    path = shared_dir(spark, "tests", "table")
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    replace_table(df, "clickflow_test_t", path)
    replace_table(df.union(df), "clickflow_test_t", path)
    assert spark.table("clickflow_test_t").count() == 2
    spark.sql("DROP TABLE clickflow_test_t")


DAY = 86_400_000
NEW_YEAR = 1704067200000  # 2024-01-01


class Feed:
    """A stream over a folder of log files: each round takes what was added since the last one."""

    def __init__(self, spark, hops=("city_counts", "province_top3"), threshold=100, **options):
        self.spark, self.hops, self.root = spark, hops, shared_dir(spark, "tests", "feed")
        self.stream = AS.AdStream(spark, f"{self.root}/tables", TaskParams(ad_click_threshold=threshold), **options)

    def add(self, *clicks):
        """Lines (millis after the new year, province, city, user, ad), or text as it is."""
        lines = [c if isinstance(c, str) else " ".join(map(str, (NEW_YEAR + c[0], *c[1:]))) for c in clicks]
        if lines:
            self.spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{self.root}/in")
        self.stream.round(file_lines(self.spark, f"{self.root}/in"), self.hops)
        return self.stream

    def replay(self, hop):
        """As after a crash between a hop's last batch and its commit."""
        folder = Path(f"{self.root}/tables/_checkpoints/{hop}/commits".removeprefix("file:"))
        last = max((f for f in folder.iterdir() if f.name.isdigit()), key=lambda f: int(f.name))
        last.unlink()
        (folder / f".{last.name}.crc").unlink(missing_ok=True)


def state_of(stream, hop):
    """The live groups of a hop, from Spark's own state store."""
    return stream.spark.read.format("statestore").load(f"{stream.root}/_checkpoints/{hop}")


def test_totals_run_on_in_the_state(spark):
    feed = Feed(spark)
    feed.add((0, 1, 1, 5, 7), (1000, 1, 1, 5, 7), (2000, 2, 2, 6, 7))
    stream = feed.add((3000, 1, 1, 6, 7), (4000, 1, 1, 6, 8))
    assert rows(stream.city_counts()) == [("20240101", "1", "1", 7, 3), ("20240101", "1", "1", 8, 1), ("20240101", "2", "2", 7, 1)]
    assert rows(stream.province_top3()) == [("20240101", "1", 7, 3), ("20240101", "1", 8, 1), ("20240101", "2", 7, 1)]
    state = state_of(stream, "ad_stat").select("key.province", "key.adid", "value.count")
    assert rows(state) == [("1", 7, 3), ("1", 8, 1), ("2", 7, 1)]


def test_replayed_batches_add_nothing(spark):
    feed = Feed(spark, hops=("city_counts", "trend", "province_top3"), threshold=2)
    feed.add(*[(i, 1, 1, 5, 7) for i in range(4)], (5, 2, 2, 6, 7))
    stream = feed.add(*[(i, 1, 1, 6, 8) for i in range(10, 13)])
    tables = (stream.city_counts, stream.trend, stream.province_top3, stream.blacklist, stream.clean_clicks)
    before = [rows(t()) for t in tables]
    assert before[0] == [("20240101", "1", "1", 7, 4), ("20240101", "1", "1", 8, 3), ("20240101", "2", "2", 7, 1)]
    assert before[3] == [(5,), (6,)]
    for hop in ("clean_clicks", "ad_stat", "ad_click_trend", "ad_province_top3", "blacklist"):
        feed.replay(hop)
    feed.add()
    assert [rows(t()) for t in tables] == before
    feed.add((20, 1, 1, 7, 7))
    assert rows(stream.city_counts())[0] == ("20240101", "1", "1", 7, 5)


def test_a_listed_user_is_filtered_from_the_next_round(spark):
    feed = Feed(spark, threshold=2)
    feed.add(*[(i, 1, 1, 5, 7) for i in range(4)])  # all four count: the user is listed after them
    stream = feed.add((60_000, 1, 1, 5, 7), (60_001, 1, 1, 6, 7))
    assert rows(stream.blacklist()) == [(5,)]
    assert rows(stream.city_counts()) == [("20240101", "1", "1", 7, 5)]
    assert rows(stream.clean_clicks().where(F.col("ts_millis") >= NEW_YEAR + 60_000), "userid") == [(6,)]
    feed.add((70_000, 1, 1, 5, 7))  # nothing but clicks of listed users
    assert rows(stream.city_counts()) == [("20240101", "1", "1", 7, 5)]
    assert rows(stream._listed()) == [(5, 0)]  # inserted once


def test_old_state_is_dropped_and_later_clicks_with_it(spark):
    feed = Feed(spark, late="1 day")
    stream = feed.add((0, 1, 1, 5, 7), (DAY, 1, 1, 5, 7))
    live = lambda: rows(state_of(stream, "ad_stat").select(F.date_format("key.window.start", "yyyyMMdd")))
    assert live() == [("20240101",), ("20240102",)]
    feed.add((DAY - 1, 1, 1, 6, 7))  # a day late at most: counts
    assert rows(stream.city_counts())[0] == ("20240101", "1", "1", 7, 2)
    feed.add((9 * DAY, 1, 1, 5, 7))
    assert live() == [("20240110",)]
    feed.add((5, 1, 1, 8, 7), (9 * DAY + 1, 1, 1, 8, 7))
    assert live() == [("20240110",)]
    # results of closed days stay; the click that came later than the lateness is not in them
    assert rows(stream.city_counts()) == [("20240101", "1", "1", 7, 2), ("20240102", "1", "1", 7, 1), ("20240110", "1", "1", 7, 2)]
    assert rows(stream.province_top3()) == [("20240101", "1", 7, 2), ("20240102", "1", 7, 1), ("20240110", "1", 7, 2)]


def test_sliding_hours_come_once_when_they_are_over(spark):
    minute = 60_000
    feed = Feed(spark, hops=("recent_hour",))
    stream = feed.add((0, 1, 1, 5, 7), (1, 1, 1, 6, 7), (30 * minute, 1, 1, 5, 7))
    first = rows(stream.recent_hour())
    # the latest click is at 00:30, so hours that end at 00:29 or before are over
    assert len(first) == 29 and first[0] == ("2023-12-31 23:01", "2024-01-01 00:01", 7, 2) and first[-1][1] == "2024-01-01 00:29"
    feed.add((200 * minute, 1, 1, 5, 8))
    got = rows(stream.recent_hour())
    assert len(got) == len(set(got)) == 90 and set(first) < set(got)
    clicks = [(0, 2), (30, 1)]
    for start, _, ad, count in got:
        at = (dt.datetime.fromisoformat(start) - dt.datetime(2024, 1, 1)) // dt.timedelta(minutes=1)
        assert (ad, count) == (7, sum(c for m, c in clicks if at <= m < at + 60))


def test_rejected_lines_are_kept(spark):
    feed = Feed(spark, hops=())
    stream = feed.add("", "x 1 1 5 7", "1 2 3", (0, 1, 1, 5, 7), f"{NEW_YEAR} 1 1 5 x")
    feed.add("x 1 1 5 7")
    assert rows(stream.rejected_lines()) == [("",), ("1 2 3",), (f"{NEW_YEAR} 1 1 5 x",), ("x 1 1 5 7",), ("x 1 1 5 7",)]
    assert stream.clean_clicks().count() == 1


def test_top3_from_changes_equals_the_whole(spark):
    """Only changed totals reach the ranking; the result is that of all totals, with ties by ad."""
    rng = random.Random(5)
    feed, seen = Feed(spark, hops=("province_top3",)), []
    for batch in range(4):
        new = [(rng.randrange(3) * DAY, rng.randrange(2), 1, i, rng.randrange(8)) for i in range(25)]
        seen += new
        stream = feed.add(*new)
        lines = spark.createDataFrame([(" ".join(map(str, (NEW_YEAR + c[0], *c[1:]))),) for c in seen], "value string")
        want = AD.ad_province_top3(AD.ad_province_click_count(AD.parse_ad_log(lines)))
        assert rows(stream.province_top3()) == rows(want), batch


def test_a_stream_of_nothing(spark):
    feed = Feed(spark, hops=AS.AdStream.COUNTING)
    stream = feed.add("no click")
    for table in (stream.city_counts, stream.trend, stream.province_top3, stream.blacklist, stream.clean_clicks, stream.recent_hour):
        assert table().count() == 0


def test_rounds_stop_and_go_on(spark):
    """A new run over the same folders goes on where the last one stopped."""
    root = shared_dir(spark, "tests", "rounds")
    lines = [f"{NEW_YEAR + i * 61000} {i % 3} {i % 3} {i % 7} {i % 4}" for i in range(60)]
    for part in (lines[:20], lines[20:]):
        spark.createDataFrame([(x,) for x in part], "value string").write.mode("append").text(f"{root}/in")
        stream = PG.ad_program(file_lines(spark, f"{root}/in"), TaskParams(), f"{root}/out", rounds=1)
    clicks = AD.parse_ad_log(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert rows(stream.city_counts()) == rows(AD.ad_city_count(clicks))
    assert rows(stream.trend()) == rows(AD.ad_click_trend(clicks))
    assert rows(stream.province_top3()) == rows(AD.ad_province_top3(AD.ad_province_click_count(clicks)))


def test_partitioned_writes_are_clustered(spark):
    path = shared_dir(spark, "tests", "clustered")
    write_partitioned(spark.range(1000, numPartitions=16).withColumn("day", F.col("id") % 3), path, ["day"])
    for day in range(3):
        assert len(list(Path(path.removeprefix("file:"), f"day={day}").glob("part-*"))) == 1


def test_replace_groups_is_one_pass(spark):
    from clickflow.sinks import merge as M

    old = spark.createDataFrame([("d1", "p1", 1), ("d1", "p2", 2), (None, "p1", 3)], "date string, province string, adid long")
    new = spark.createDataFrame([("d1", "p1", 9), (None, "p1", 8)], "date string, province string, adid long")
    got = M.replace_groups(old, new, ["date", "province"])
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(
        map(str, [("d1", "p1", 9), ("d1", "p2", 2), (None, "p1", 8)]))
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_time_slices_hold_the_whole_log(spark, tmp_path):
    from clickflow.sources import testdata as src
    from clickflow.streaming.sources import slice_bounds, write_ad_log_slice

    sf = "/root/testdata/sf0.001"
    bounds = slice_bounds("2024-01-10", "2024-01-12", 3)
    for index in range(3):
        write_ad_log_slice(spark, sf, str(tmp_path / "log"), bounds, index)
    assert spark.read.text(str(tmp_path / "log")).count() == src.load_ad_log(spark, sf).count()


def test_blacklist_filter_takes_the_log_in_five_slices(spark, tmp_path):
    import duckdb

    from clickflow.plans import stream_queries as SQ

    assert SQ.SLICES == 5
    assert [f"{b:%m-%d %H}" for b in SQ.BOUNDS] == ["01-07 00", "01-13 00", "01-19 00", "01-25 00"]
    times = {
        # listed by the first slice, whose clicks pass; none after it does
        7: ["01-05 08:00", "01-05 09:00", "01-05 10:00", "01-06 23:59", "01-07 00:00", "01-08 06:00", "01-30 06:00"],
        # listed by the third slice
        8: ["01-02 08:00", "01-13 00:00", "01-13 01:00", "01-13 02:00", "01-18 23:59", "01-19 00:00", "01-24 12:00"],
        # never above two clicks a day
        9: ["01-07 00:00", "01-07 01:00", "01-25 00:00"],
    }
    clicks = [(i, f"2024-{at}:00", user) for i, (user, at) in enumerate((u, at) for u, ats in times.items() for at in ats)]
    events = spark.createDataFrame(clicks, "event_id long, at string, user_id long")
    events = events.withColumn("ts", F.col("at").cast("timestamp_ntz")).withColumn("event_type", F.lit("click")).withColumn("value", F.lit(1.0))
    events.withColumn("props", F.lit('{"k": 3}')).drop("at").write.parquet(f"{tmp_path}/events.parquet")

    got = rows(SQ.q_stream_blacklist_filter(spark, str(tmp_path)))
    assert sorted((r[4], f"{dt.datetime.fromtimestamp(r[0] / 1000, dt.timezone.utc):%m-%d %H:%M}") for r in got) == sorted(
        [(7, at) for at in times[7][:4]] + [(8, at) for at in times[8][:5]] + [(9, at) for at in times[9]])
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    for other in ("customer", "part"):
        con.execute(f"CREATE VIEW {other} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{other}.parquet')")
    assert sorted(con.execute(SQ.BLACKLIST_FILTER_SQL).fetchall()) == got
