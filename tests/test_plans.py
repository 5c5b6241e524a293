"""Plan checks: pushdown, pruning, broadcast of bounded sides, top-k limits, no Python."""

import pytest

from clickflow.plans import registry as E
from conftest import SMOKE_DIR

QUERIES = E.queries()
BATCH = sorted(n for n in QUERIES if not n.startswith("stream_"))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


def formatted(spark, name):
    df = QUERIES[name](spark, SMOKE_DIR)
    return df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_date_range_is_pushed_to_the_scan(spark):
    text = formatted(spark, "actions_in_date_range")
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in text


def test_two_column_projection_prunes_the_scan(spark):
    text = formatted(spark, "city_product_clicks")
    read = [line for line in text.splitlines() if "ReadSchema" in line]
    assert read and all("user_id" not in r and "value" not in r for r in read)


@pytest.mark.parametrize("name", ["area_top3_products", "ad_province_top3", "top10_active_sessions", "session_sample_hourly"])
def test_top_k_windows_get_a_group_limit(spark, name):
    assert "WindowGroupLimit" in formatted(spark, name)


def test_city_dimension_is_broadcast(spark):
    assert "BroadcastHashJoin" in formatted(spark, "area_basic_info")


def test_top10_uses_take_ordered(spark):
    assert "TakeOrderedAndProject" in formatted(spark, "top10_categories")


@pytest.mark.parametrize("name", BATCH)
def test_no_python_in_the_row_path(spark, name):
    text = formatted(spark, name)
    for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
        assert marker not in text, f"{name}: {marker}"
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def _broadcast_subtrees(plan: str) -> list[str]:
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            sub = []
            for nxt in lines[i + 1:]:
                if len(nxt) - len(nxt.lstrip(" :+-")) <= depth:
                    break
                sub.append(nxt)
            out.append("\n".join(sub))
    return out


BOUNDED_ROOTS = ("HashAggregate", "LocalTableScan", "TakeOrderedAndProject", "GlobalLimit", "CollectLimit")


@pytest.mark.parametrize("name", ["page_conversion_rate", "area_basic_info", "actions_in_top10_categories"])
def test_only_bounded_sides_are_broadcast(spark, name):
    # What is broadcast must be an aggregate, a limit or a literal table (the flow,
    # the city dimension, the top-10): never rows streaming from the events scan.
    df = QUERIES[name](spark, SMOKE_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    subtrees = _broadcast_subtrees(plan)
    assert subtrees
    for sub in subtrees:
        lines = [line.strip(" :+-") for line in sub.splitlines()]
        first = next(line for line in lines if line.split(" ")[0] not in ("Project", "Filter"))
        op = first.split(" ")[0].split("(")[0]
        # A dimension scan may be broadcast by Spark's own size check; the fact table never.
        ok = op in BOUNDED_ROOTS or (op == "FileScan" and "events.parquet" not in first)
        assert ok, (name, first[:120])
