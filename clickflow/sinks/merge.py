"""The merge forms of the result tables, as pure DataFrame functions (old, new → merged).

They are what the stored tables look like after a batch is written, expressed as
joins and aggregates so that they run distributed and can be re-run safely.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def upsert_accumulate(old: DataFrame, new: DataFrame, keys: list[str], value: str = "click_count") -> DataFrame:
    """Insert new keys, add the new value to existing ones (``value = value + ?``)."""
    cols = [*keys, value]
    both = old.select(*cols).unionByName(new.select(*cols))
    return both.groupBy(*keys).agg(F.sum(value).alias(value))


def upsert_overwrite(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Insert new keys, replace the row of existing ones."""
    kept = old.join(new.select(*keys), keys, "left_anti")
    return new.unionByName(kept.select(*new.columns))


def replace_groups(old: DataFrame, new: DataFrame, group_keys: list[str]) -> DataFrame:
    """Delete every group of ``old`` that appears in ``new``, then insert ``new``.

    One pass over each side and one shuffle by group. Groups are the short lists of a
    top-k table, so a group's window is bounded by twice k. Null keys form a group too.
    """
    columns = new.columns
    both = new.withColumn("__new", F.lit(True)).unionByName(old.select(*columns).withColumn("__new", F.lit(False)))
    newest = F.max("__new").over(Window.partitionBy(*group_keys))
    return both.withColumn("__newest", newest).where(F.col("__new") == F.col("__newest")).select(*columns)


def insert_new(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Insert-if-absent: the table after adding the new keys it does not hold yet."""
    added = new.select(*keys).distinct().join(existing.select(*keys), keys, "left_anti")
    return existing.select(*keys).unionByName(added)
