"""Properties over the provided data and random merge inputs."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickflow.operators import funnel as FN
from clickflow.operators import sessions as S
from clickflow.params import DEFAULT_PARAMS
from clickflow.plans import jobs
from clickflow.plans.session_queries import FILTER_VARIANTS
from clickflow.sinks import merge as M
from conftest import SMOKE_DIR, rows


def test_bucket_counts_never_exceed_sessions(spark):
    c = S.session_bucket_counts(jobs.full_sessions(spark, SMOKE_DIR, DEFAULT_PARAMS)).first().asDict()
    visit = sum(c[n] for n in S.bucket_names() if n.startswith("visit"))
    step = sum(c[n] for n in S.bucket_names() if n.startswith("step"))
    assert visit <= c["session_count"] and step == c["session_count"]


def test_filtered_sessions_are_a_subset(spark):
    all_ids = set(rows(jobs.full_sessions(spark, SMOKE_DIR, DEFAULT_PARAMS), "session_id"))
    for params in FILTER_VARIANTS.values():
        assert set(rows(jobs.filtered_sessions(spark, SMOKE_DIR, params), "session_id")) <= all_ids


def test_every_action_but_the_last_of_a_session_starts_a_pair(spark):
    actions = jobs.date_range_actions(spark, SMOKE_DIR, DEFAULT_PARAMS)
    n_actions = actions.count()
    n_sessions = actions.select("session_id").distinct().count()
    assert FN.page_transitions(actions).count() == n_actions - n_sessions


KEYS = ["date", "userid", "adid"]
SCHEMA = "date string, userid long, adid long, click_count long"
row = st.tuples(st.sampled_from(["20240101", "20240102"]), st.integers(0, 3), st.integers(0, 2), st.integers(1, 5))


def _dedup(data):
    return list({r[:3]: r for r in data}.values())


@settings(max_examples=8, deadline=None)
@given(st.lists(row, max_size=8), st.lists(row, max_size=8))
def test_merge_properties(spark, a, b):
    da, db = spark.createDataFrame(_dedup(a), SCHEMA), spark.createDataFrame(_dedup(b), SCHEMA)
    assert rows(M.upsert_accumulate(da, db, KEYS)) == rows(M.upsert_accumulate(db, da, KEYS))
    once = M.upsert_overwrite(da, db, KEYS)
    assert rows(M.upsert_overwrite(once, db, KEYS)) == rows(once)
    total = M.upsert_accumulate(da, db, KEYS).agg(F.sum("click_count")).first()[0] or 0
    assert total == sum(r[3] for r in _dedup(a)) + sum(r[3] for r in _dedup(b))


action_row = st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5), st.integers(0, 9))


@settings(max_examples=6, deadline=None)
@given(st.lists(action_row, min_size=1, max_size=40))
def test_page_transitions_equal_brute_force(spark, acts):
    from clickflow.sources.schemas import USER_VISIT_ACTION

    # Few distinct seconds: many ties inside a second (broken by event id) and many
    # chunk borders; sessions of one action give no pair.
    data = [("2024-01-01", 1, sid, page, f"2024-01-01 00:00:{sec:02d}", None, -1, -1, None, None, None, None, 0, eid)
            for eid, (sid, sec, page) in enumerate(acts)]
    df = spark.createDataFrame(data, USER_VISIT_ACTION)
    by_session = {}
    for eid, (sid, sec, page) in enumerate(acts):
        by_session.setdefault(sid, []).append((sec, eid, page))
    want = []
    for sid, seq in by_session.items():
        seq.sort()
        want += [(sid, a[1], a[2], b[2]) for a, b in zip(seq, seq[1:])]
    assert rows(FN.page_transitions(df)) == sorted(want)
