"""Hand-made rows for the session statistics: bucket edges, filters, dedup rules."""

import pytest
from pyspark.sql import functions as F

from clickflow.operators import sessions as S
from clickflow.params import TaskParams
from clickflow.sources.schemas import USER_INFO, USER_VISIT_ACTION
from conftest import rows

BASE = "2024-01-01 00:00:00"


def action(sid, t, user=1, kw=None, cid=-1, eid=0, page=0):
    return ("2024-01-01", user, sid, page, t, kw, cid, -1, None, None, None, None, 0, eid)


def seconds(n):
    m, s = divmod(n, 60)
    h, m = divmod(m, 60)
    return f"2024-01-01 {h:02d}:{m:02d}:{s:02d}"


def test_visit_length_bucket_edges(spark):
    edges = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801]
    data = []
    for i, e in enumerate(edges):
        data += [action(f"s{i}", BASE, eid=2 * i), action(f"s{i}", seconds(e), eid=2 * i + 1)]
    summary = S.session_summary(spark.createDataFrame(data, USER_VISIT_ACTION))
    got = dict(rows(summary, "session_id", "visit_length"))
    assert [got[f"s{i}"] for i in range(len(edges))] == edges
    counts = S.session_bucket_counts(summary).first().asDict()
    assert counts["session_count"] == len(edges)
    # 1–3 s have their own bucket (not the 1–3 min one); 0 s is in no bucket.
    assert counts["visit_length_1s_3s"] == 2
    assert counts["visit_length_4s_6s"] == 2
    assert counts["visit_length_7s_9s"] == 2
    assert counts["visit_length_10s_30s"] == 2
    assert counts["visit_length_30s_60s"] == 2
    assert counts["visit_length_1m_3m"] == 2
    assert counts["visit_length_3m_10m"] == 2
    assert counts["visit_length_10m_30m"] == 2
    assert counts["visit_length_30m"] == 1
    assert sum(counts[n] for n in S.bucket_names() if n.startswith("visit")) == len(edges) - 1


def test_step_length_bucket_edges(spark):
    steps = [1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61]
    data = [action(f"s{i}", BASE, eid=i * 100 + j) for i, n in enumerate(steps) for j in range(n)]
    summary = S.session_summary(spark.createDataFrame(data, USER_VISIT_ACTION))
    counts = S.session_bucket_counts(summary).first().asDict()
    assert [counts[f"step_length_{n}"] for n in ["1_3", "4_6", "7_9", "10_30", "30_60", "60"]] == [2, 2, 2, 2, 2, 1]


def test_summary_dedup_is_exact(spark):
    # A keyword contained in another and category ids whose text overlaps survive.
    data = [
        action("a", BASE, kw="kw11", cid=11, eid=1),
        action("a", BASE, kw="kw1", cid=1, eid=2),
        action("a", BASE, kw="kw1", cid=1, eid=3),
        action("a", BASE, kw="", cid=-1, eid=4),
        action("a", BASE, kw=None, cid=100, eid=5, user=7),
    ]
    r = S.session_summary(spark.createDataFrame(data, USER_VISIT_ACTION)).first()
    assert r["search_keywords"] == "kw1,kw11"
    assert r["click_category_ids"] == "1,11,100"  # numeric order
    assert r["user_id"] == 1  # min(user_id)
    assert r["step_length"] == 5


def test_empty_lists_are_empty_text(spark):
    r = S.session_summary(spark.createDataFrame([action("a", BASE)], USER_VISIT_ACTION)).first()
    assert r["search_keywords"] == "" and r["click_category_ids"] == ""


@pytest.fixture
def full_info(spark):
    users = spark.createDataFrame(
        [
            (1, "u1", "n1", 20, "BUILDING", "city3", "male"),
            (2, "u2", "n2", 50, "MACHINERY", "city7", "female"),
            (3, "u3", "n3", 51, "HOUSEHOLD", "city1", "male"),
            (4, "u4", "n4", None, "BUILDING", "city3", "female"),
        ],
        USER_INFO,
    )
    data = [
        action("s1", BASE, user=1, kw="kw1", cid=5, eid=1),
        action("s2", BASE, user=2, kw="kw3", cid=40, eid=2),
        action("s3", BASE, user=3, kw="kw2", cid=6, eid=3),
        action("s4", BASE, user=4, eid=4),
    ]
    summary = S.session_summary(spark.createDataFrame(data, USER_VISIT_ACTION))
    return S.session_full_info(summary, users)


def _ids(df):
    return [r[0] for r in rows(df, "session_id")]


def test_filters(full_info):
    none = TaskParams(start_age=None, end_age=None)
    assert _ids(S.session_filter(full_info, none)) == ["s1", "s2", "s3", "s4"]
    # Age: inclusive, null age fails, one bound set means no restriction.
    assert _ids(S.session_filter(full_info, none.with_(start_age=20, end_age=50))) == ["s1", "s2"]
    assert _ids(S.session_filter(full_info, none.with_(start_age=20))) == ["s1", "s2", "s3", "s4"]
    assert _ids(S.session_filter(full_info, none.with_(professionals="BUILDING"))) == ["s1", "s4"]
    assert _ids(S.session_filter(full_info, none.with_(cities="city7,city1"))) == ["s2", "s3"]
    assert _ids(S.session_filter(full_info, none.with_(sex="female"))) == ["s2", "s4"]
    assert _ids(S.session_filter(full_info, none.with_(keywords="kw1,kw3"))) == ["s1", "s2"]
    assert _ids(S.session_filter(full_info, none.with_(category_ids="40"))) == ["s2"]
    # Empty text means unset.
    assert _ids(S.session_filter(full_info, none.with_(keywords="", sex=""))) == ["s1", "s2", "s3", "s4"]
    both = none.with_(start_age=20, end_age=50, sex="male")
    assert _ids(S.session_filter(full_info, both)) == ["s1"]


def test_ratio_half_up(spark):
    df = spark.createDataFrame([(57, 200), (1, 3), (2, 3), (0, 0), (7, 7), (10**15 + 5, 2 * 10**15)], "c long, t long")
    from clickflow.functions.numbers import ratio_half_up

    got = [r[0] for r in df.select(ratio_half_up("c", "t")).collect()]
    assert got == [0.29, 0.33, 0.67, None, 1.0, 0.5]  # 0.285 rounds up; exact at large counts


def test_a_session_of_a_million_keywords(spark):
    n = 1_000_000
    words = spark.range(n + 1000, numPartitions=8).select(
        F.lit("2024-01-01").alias("date"), F.lit(1).cast("long").alias("user_id"), F.lit("s").alias("session_id"),
        F.lit("2024-01-01 00:00:00").alias("action_time"), F.concat(F.lit("k"), (F.col("id") % n).cast("string")).alias("search_keyword"),
        F.lit(-1).cast("long").alias("click_category_id"),
    )
    got = S.session_summary(words).select("step_length", F.size(F.split("search_keywords", ",")).alias("n")).first()
    assert tuple(got) == (n + 1000, n)
