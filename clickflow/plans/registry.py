"""The query registry: name → (Spark callable, DuckDB oracle SQL or None).

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the whole tables
of ``sf_dir``; only the ``stream_*`` keys run jobs (their streams) before it is read. Parameter variants are fixed here, next to their oracle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    fn: QueryFn
    sql: str | None
    # Streaming runs and other keys compared with a batch oracle are marked here.
    streaming: bool = False


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None, streaming: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(fn, sql, streaming)
        return fn

    return deco


BLOCKS = (
    "session_queries",
    "category_queries",
    "funnel_queries",
    "area_queries",
    "ad_queries",
    "helper_queries",
    "stream_queries",
)


def _load() -> None:
    import importlib

    for block in BLOCKS:
        importlib.import_module(f"clickflow.plans.{block}")


def queries() -> dict[str, QueryFn]:
    _load()
    return {name: e.fn for name, e in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: e.sql for name, e in REGISTRY.items() if e.sql is not None}
