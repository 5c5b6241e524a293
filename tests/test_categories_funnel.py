"""Top-k ties, the page funnel against brute force, and the area top-3."""

import random
import re

from pyspark.sql import functions as F

from clickflow.operators import areas as A
from clickflow.operators import categories as C
from clickflow.operators import funnel as FN
from clickflow.params import TaskParams
from clickflow.sources.cities import city_area_info
from clickflow.sources.schemas import USER_VISIT_ACTION
from conftest import rows


def act(sid, t, page=0, cid=-1, order=None, pay=None, eid=0, city=0, pid=-1):
    return ("2024-01-01", 1, sid, page, t, None, cid, pid, order, None, pay, None, city, eid)


def test_category_counts_and_ties(spark):
    data = [
        act("a", "2024-01-01 00:00:00", cid=3, eid=1),
        act("a", "2024-01-01 00:00:01", cid=2, eid=2),
        act("b", "2024-01-01 00:00:02", order="2,3", eid=3),
        act("b", "2024-01-01 00:00:03", pay="3", eid=4),
        act("b", "2024-01-01 00:00:04", order="7", eid=5),
    ]
    df = spark.createDataFrame(data, USER_VISIT_ACTION)
    full = C.category_full_count(df)
    assert rows(full) == [(2, 1, 1, 0), (3, 1, 1, 1), (7, 0, 1, 0)]
    # Ties on (click, order, pay) break by category id ascending.
    top = C.top_categories(full, 2)
    assert [r[0] for r in top.collect()] == [3, 2]
    assert rows(C.touched_categories(df)) == [(2,), (3,), (7,)]


def test_top_sessions_ties(spark):
    data = [act(s, "2024-01-01 00:00:00", cid=1, eid=i) for i, s in enumerate(["b", "a", "c", "c"])]
    df = spark.createDataFrame(data, USER_VISIT_ACTION)
    cats = spark.createDataFrame([(1,)], "category_id long")
    got = [(r.session_id, r.click_count, r.rank) for r in C.top_active_sessions(df, cats, 2).orderBy("rank").collect()]
    assert got == [("c", 2, 1), ("a", 1, 2)]


def _brute_pairs(data):
    by = {}
    for r in data:
        by.setdefault(r[2], []).append(r)
    out = []
    for sid, acts in by.items():
        acts.sort(key=lambda r: (r[4], r[13]))
        out += [(sid, a[13], a[3], b[3]) for a, b in zip(acts, acts[1:])]
    return sorted(out)


def test_page_transitions_match_brute_force(spark):
    rnd = random.Random(7)
    data = []
    eid = 0
    # One hot session spread over many minutes (crosses chunk edges), equal times,
    # and many small sessions.
    for sid, n, span in [("hot", 400, 3600), *[(f"s{i}", rnd.randint(1, 6), 200) for i in range(40)]]:
        for _ in range(n):
            sec = rnd.randint(0, span)
            data.append(act(sid, f"2024-01-01 {sec // 3600:02d}:{sec % 3600 // 60:02d}:{sec % 60:02d}",
                            page=rnd.randint(0, 9), eid=eid))
            eid += 1
    df = spark.createDataFrame(data, USER_VISIT_ACTION)
    got = rows(FN.page_transitions(df))
    assert got == _brute_pairs(data)


def test_conversion_missing_pair_and_zero_start(spark):
    data = [act("a", "2024-01-01 00:00:00", page=1, eid=1), act("a", "2024-01-01 00:00:01", page=2, eid=2),
            act("b", "2024-01-01 00:00:00", page=1, eid=3), act("b", "2024-01-01 00:00:01", page=2, eid=4)]
    df = spark.createDataFrame(data, USER_VISIT_ACTION)
    p = TaskParams(target_page_flow="1,2,3")
    out = FN.page_conversion_rate(df, FN.page_transitions(df), p).orderBy("pos").collect()
    assert [(r.pair, r.pair_count, r.prev_count, r.convert_rate) for r in out] == [
        ("1_2", 2, 2, 1.0), ("2_3", 0, 2, 0.0)
    ]
    # No view of the first page: the first rate has a zero denominator → null.
    p9 = TaskParams(target_page_flow="9,1,2")
    out = FN.page_conversion_rate(df, FN.page_transitions(df), p9).orderBy("pos").collect()
    assert [(r.pair_count, r.convert_rate) for r in out] == [(0, None), (2, None)]


def test_area_top3_ties_and_unknown_city(spark):
    data = [act("a", "2024-01-01 00:00:00", city=c, pid=p, eid=i)
            for i, (c, p) in enumerate([(1, 10), (2, 10), (1, 11), (2, 12), (1, 13), (2, 13), (11, 10)])]
    df = spark.createDataFrame(data, USER_VISIT_ACTION)
    basic = A.area_basic_info(A.city_product_clicks(df), city_area_info(spark))
    assert basic.count() == 6  # city 11 is unknown
    counts = A.area_product_click_count(basic)
    assert rows(counts.where(F.col("pid") == 13), "city_infos") == [("1:上海,2:南京",)]
    products = spark.createDataFrame([(p, f"p{p}", '{"product_status": %d}' % (p % 2)) for p in range(10, 14)],
                                     "product_id long, product_name string, extend_info string")
    top = A.area_top3_products(A.area_product_info(counts, products))
    got = [(r.area_level, r.pid, r.click_count, r.product_status) for r in top.orderBy(F.desc("click_count"), "pid").collect()]
    assert got == [("A_Level", 10, 2, "Self"), ("A_Level", 13, 2, "Third Party"), ("A_Level", 11, 1, "Third Party")]


def test_rank_within_groups_matches_row_number(spark):
    from pyspark.sql import Window

    from clickflow.operators.ranking import rank_within_groups

    rnd = random.Random(3)
    # One hot group with most rows, a few small ones, many ties on the score.
    data = [("hot" if rnd.random() < 0.7 else f"g{rnd.randint(0, 4)}", rnd.randint(0, 5), i) for i in range(3000)]
    df = spark.createDataFrame(data, "g string, score long, id long").repartition(12)
    order = [F.desc("score"), F.asc("id")]
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    whole = df.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "g", "id")))
    for piece in (100_000, 50, 1):  # ties numbered whole, and cut into pieces
        got = rank_within_groups(df, ["g"], [-F.col("score")], "id", piece=piece)
        assert rows(got) == rows(want), piece
        assert rows(rank_within_groups(df, [], [-F.col("score"), F.col("g")], "id", piece=piece)) == rows(whole), piece


def test_row_with_several_kinds_counts_in_each(spark):
    # One action that is a click on 4 and an order of 4 and 9: every kind counts
    # and every category is a candidate (the union, not the first kind only).
    data = [act("a", "2024-01-01 00:00:00", cid=4, order="4,9", pay="9", eid=1)]
    df = spark.createDataFrame(data, USER_VISIT_ACTION)
    assert rows(C.category_full_count(df)) == [(4, 1, 1, 0), (9, 0, 1, 1)]
    assert rows(C.touched_categories(df)) == [(4,), (9,)]


def test_page_transitions_without_event_ids(spark):
    from clickflow.operators.funnel import page_transitions

    rows = [("s", "2024-01-01 00:00:01", 3), ("s", "2024-01-01 00:00:01", 1), ("s", "2024-01-01 09:00:00", 2)]
    df = spark.createDataFrame(rows, "session_id string, action_time string, page_id long")
    got = sorted((r.from_page_id, r.to_page_id) for r in page_transitions(df).collect())
    assert got == [(1, 3), (3, 2)]


def test_ad_lines_of_any_long_and_rejects(spark):
    from clickflow.operators.ads import parse_ad_log, rejected_ad_lines

    good = ["1704067200000 p c 9000000000000000001 7", "1704067200000 p c 1 7 more fields"]
    bad = ["999999999999999999 p c 1 7", "1704067200000 p c x 7", "short line", "short line", ""]
    lines = spark.createDataFrame([(x,) for x in good + bad] + [(None,)], "value string")
    clicks = parse_ad_log(lines)
    assert sorted((r.date, r.userid, r.adid) for r in clicks.collect()) == [(clicks.first().date, 1, 7), (clicks.first().date, 9000000000000000001, 7)]
    assert {r.line: r.occurrences for r in rejected_ad_lines(lines).collect()} == {None: 1, "": 1, "short line": 2, bad[0]: 1, bad[1]: 1}


def test_sessions_are_joined_after_counting(spark):
    sf = "/root/testdata/sf0.001"
    from clickflow.params import DEFAULT_PARAMS
    from clickflow.plans import jobs

    plan = jobs.filtered_session_counts(spark, sf, DEFAULT_PARAMS)._jdf.queryExecution().optimizedPlan().toString()
    join = re.search(r"Join Inner, \(session_id#", plan)
    counted = re.search(r"Aggregate \[session_id#\d+, category_id#", plan)
    assert "LeftSemi" not in plan and join and counted and join.start() < counted.start()
