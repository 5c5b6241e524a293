"""The four jobs as runnable programs: read inputs, compute every output table, write.

Inputs are DataFrames (``Inputs``), so a deployment plugs in its own tables
(``inputs_from_tables``) and tests use the provided data (``inputs_from_testdata``).
Outputs go to a ``Sink``: Parquet folders, or JDBC for the session ratio table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.config import shared_dir
from clickflow.operators import areas as A
from clickflow.operators import categories as C
from clickflow.operators import funnel as FN
from clickflow.operators import sampling as SM
from clickflow.operators import sessions as S
from clickflow.params import TaskParams
from clickflow.sinks.writers import append_jdbc
from clickflow.sources import testdata as src
from clickflow.sources.cities import city_area_info
from clickflow.streaming import ad_stream as AS


@dataclass
class Inputs:
    actions: DataFrame  # user_visit_action
    users: DataFrame  # user_info
    products: DataFrame  # product_info


def inputs_from_testdata(spark: SparkSession, sf_dir: str, params: TaskParams) -> Inputs:
    return Inputs(src.load_actions(spark, sf_dir, params), src.load_users(spark, sf_dir), src.load_products(spark, sf_dir))


def inputs_from_tables(spark: SparkSession, tables_dir: str) -> Inputs:
    """Parquet folders ``user_visit_action`` (may be partitioned by ``date``),
    ``user_info`` and ``product_info`` under ``tables_dir``."""
    def read(name):
        return spark.read.parquet(f"{tables_dir.rstrip('/')}/{name}")

    return Inputs(read("user_visit_action"), read("user_info"), read("product_info"))


@dataclass
class Sink:
    out_dir: str
    jdbc_url: str | None = None  # when set, the session ratio row is appended there
    jdbc_properties: dict[str, str] = field(default_factory=dict)

    def write(self, name: str, df: DataFrame, mode: str = "overwrite") -> None:
        df.write.mode(mode).parquet(f"{self.out_dir.rstrip('/')}/{name}")


def _materialize(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Write an intermediate that several outputs share and read it back (cuts the
    lineage; stored in the shared checkpoint folder, never on a local disk)."""
    path = shared_dir(spark, "programs", name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def session_program(spark: SparkSession, inputs: Inputs, params: TaskParams, sink: Sink) -> None:
    """Session statistics: ratios, top-10 categories, their top-10 sessions, sample."""
    actions = S.actions_in_date_range(inputs.actions, params)
    summary = S.session_summary(actions)
    sessions = _materialize(S.session_filter(S.session_full_info(summary, inputs.users), params), spark, "sessions")
    ratio = S.session_ratio(sessions, params)
    if sink.jdbc_url:
        append_jdbc(ratio, sink.jdbc_url, "session_aggr_stat", sink.jdbc_properties)
    else:
        sink.write("session_aggr_stat", ratio, mode="append")

    task = F.lit(params.task_id).alias("taskid")
    counts = C.counts_of_sessions(C.session_category_counts(actions), sessions)
    counts = _materialize(counts, spark, "session_category_counts")
    top = _materialize(C.top_categories(C.full_count_of_sessions(counts)), spark, "top10")
    sink.write("top10_category", top.select(task, *top.columns))
    top_sessions = C.top_sessions_of_counts(counts, top)
    sink.write("top10_session", top_sessions.select(task, *top_sessions.columns))

    sample = SM.session_sample_hourly(sessions, params)
    sink.write("session_random_extract", sample)
    sink.write("session_detail", SM.session_sample_detail(actions, sample, params))


def page_program(spark: SparkSession, inputs: Inputs, params: TaskParams, sink: Sink) -> None:
    """Single-jump conversion rates along the task's page flow."""
    actions = S.actions_in_date_range(inputs.actions, params)
    rates = FN.page_conversion_rate(actions, FN.page_transitions(actions), params)
    sink.write("page_convert_rate", rates.select(F.lit(params.task_id).alias("taskid"), *rates.columns))


def area_program(spark: SparkSession, inputs: Inputs, params: TaskParams, sink: Sink) -> None:
    """Top-3 products of each area."""
    actions = S.actions_in_date_range(inputs.actions, params)
    basic = A.area_basic_info(A.city_product_clicks(actions), city_area_info(spark))
    info = A.area_product_info(A.area_product_click_count(basic), inputs.products)
    sink.write("area_top3_product", A.area_top3_products(info))


def ad_program(lines: DataFrame, params: TaskParams, out_dir: str, rounds: int | None = None) -> AS.AdStream:
    """The ad stream: a round every five seconds. Its tables, checkpoints and state live under ``out_dir``."""
    stream = AS.AdStream(lines.sparkSession, out_dir, params)
    stream.run(lines, rounds=rounds)
    return stream
