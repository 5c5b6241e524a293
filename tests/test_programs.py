"""The runnable programs write the same tables the registered queries compute."""

import __spark_entry__ as E
from clickflow.__main__ import main
from clickflow.config import shared_dir
from clickflow.params import DEFAULT_PARAMS, params_from_json
from clickflow.plans import programs as PG
from conftest import SMOKE_DIR, rows

Q = E.queries()


def test_session_page_area_programs(spark):
    out = shared_dir(spark, "tests", "programs")
    inputs = PG.inputs_from_testdata(spark, SMOKE_DIR, DEFAULT_PARAMS)
    sink = PG.Sink(out)
    PG.session_program(spark, inputs, DEFAULT_PARAMS, sink)
    PG.page_program(spark, inputs, DEFAULT_PARAMS, sink)
    PG.area_program(spark, inputs, DEFAULT_PARAMS, sink)

    def table(name):
        return spark.read.parquet(f"{out}/{name}")

    assert rows(table("session_aggr_stat")) == rows(Q["session_ratio"](spark, SMOKE_DIR))
    assert rows(table("top10_category")) == rows(Q["top10_categories"](spark, SMOKE_DIR))
    assert rows(table("top10_session")) == rows(Q["top10_active_sessions"](spark, SMOKE_DIR))
    assert rows(table("session_random_extract")) == rows(Q["session_sample_hourly"](spark, SMOKE_DIR))
    assert rows(table("session_detail")) == rows(Q["session_sample_detail"](spark, SMOKE_DIR))
    rates = table("page_convert_rate").drop("taskid")
    assert rows(rates, *sorted(rates.columns)) == rows(Q["page_conversion_rate"](spark, SMOKE_DIR), *sorted(rates.columns))
    assert rows(table("area_top3_product")) == rows(Q["area_top3_products"](spark, SMOKE_DIR))


def test_cli_runs_a_program_with_json_params(spark):
    out = shared_dir(spark, "tests", "cli")
    main(["area", "--sf-dir", SMOKE_DIR, "--out", out, "--params", '{"startDate": "2024-01-01", "endDate": "2024-01-10"}'])
    got = spark.read.parquet(f"{out}/area_top3_product")
    assert 0 < got.count() <= 3 * 7


def test_params_from_json():
    p = params_from_json(
        '{"startDate": "2024-01-02", "endDate": "2024-01-20", "startAge": "20", "endAge": "50", '
        '"professionals": "", "cities": "", "sex": "", "keywords": "", "categoryIds": "5,40", '
        '"targetPageFlow": "1,2,3"}'
    )
    assert (p.start_date, p.end_date, p.start_age, p.end_age) == ("2024-01-02", "2024-01-20", 20, 50)
    assert (p.professionals, p.cities, p.sex, p.keywords, p.category_ids) == (None, None, None, None, "5,40")
    assert p.page_pairs == [(1, 1, 2), (2, 2, 3)]
    assert params_from_json('{"startAge": ""}').start_age is None
