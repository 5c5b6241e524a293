"""Aggregate helpers built from Spark's own aggregates (partial + final, JVM side)."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def group_concat_distinct(c: Column, sep: str = ",") -> Column:
    """Distinct non-null values, sorted (binary order), joined by ``sep``; ``''`` if none.

    The set is merged map-side, so a group's state is bounded by its distinct values,
    never by its row count. The result is one text, which Spark bounds at 2 GB: a group
    with more distinct text than that ends the query with an error.
    """
    return F.array_join(F.array_sort(F.collect_set(c)), sep)


def join_distinct_numbers(c: Column, sep: str = ",") -> Column:
    """Distinct non-null numbers in numeric order, joined as text; ``''`` if none."""
    return F.array_join(F.transform(F.array_sort(F.collect_set(c)), lambda x: x.cast("string")), sep)
