"""Sinks for result tables: JDBC append, managed/external table replace, Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Append rows to a JDBC table (e.g. the one-row ``session_aggr_stat``).

    Credentials come from the caller; none are stored in this repository.
    """
    df.write.jdbc(url=url, table=table, mode="append", properties=properties or {})


def replace_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Drop-and-recreate a catalog table in one step (external when ``path`` is given)."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_partitioned(df: DataFrame, path: str, partition_by: list[str], dynamic: bool = True) -> None:
    """Overwrite only the partitions present in ``df`` (re-runs replace, never add).

    Rows are rebalanced by the partition columns first: small partitions get one file, large ones several.
    """
    writer = df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
