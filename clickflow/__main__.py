"""Command line: ``python -m clickflow {session,page,area,ads} [options]``.

Batch programs read either the provided test tables (``--sf-dir``) or tables of the
click-log model (``--tables-dir``); the ad stream reads text lines from a folder
(``--lines-dir``) or from Kafka (``--kafka-servers`` and ``--topic``).
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import SparkSession

from clickflow.config import ensure_session_defaults
from clickflow.params import DEFAULT_PARAMS, params_from_json
from clickflow.plans import programs as PG
from clickflow.streaming.sources import file_lines, kafka_lines


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="clickflow")
    ap.add_argument("program", choices=["session", "page", "area", "ads"])
    ap.add_argument("--sf-dir", help="folder with the provided parquet tables")
    ap.add_argument("--tables-dir", help="folder with user_visit_action, user_info, product_info")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--params", default="{}", help="task parameters as a JSON object")
    ap.add_argument("--jdbc-url", help="append session_aggr_stat to this JDBC database")
    ap.add_argument("--lines-dir", help="ads: folder of log text files")
    ap.add_argument("--kafka-servers", help="ads: Kafka bootstrap servers")
    ap.add_argument("--topic", help="ads: Kafka topic")
    ap.add_argument("--available-now", action="store_true", help="ads: process what is there, then stop")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"clickflow-{args.program}").getOrCreate()
    ensure_session_defaults(spark)
    # every run has a task id of its own, so appended results of several runs can be told apart
    params = params_from_json(args.params, DEFAULT_PARAMS.with_(task_id=uuid.uuid4().hex))

    if args.program == "ads":
        if args.kafka_servers:
            lines = kafka_lines(spark, args.kafka_servers, args.topic)
        else:
            lines = file_lines(spark, args.lines_dir)
        PG.ad_program(lines, params, args.out, rounds=1 if args.available_now else None)
        return

    if args.tables_dir:
        inputs = PG.inputs_from_tables(spark, args.tables_dir)
    else:
        inputs = PG.inputs_from_testdata(spark, args.sf_dir, params)
    sink = PG.Sink(args.out, args.jdbc_url)
    {"session": PG.session_program, "page": PG.page_program, "area": PG.area_program}[args.program](
        spark, inputs, params, sink
    )


if __name__ == "__main__":
    main()
