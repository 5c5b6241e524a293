"""Vectors as exact integers, numbered rows and bounded blocks, shared by the searches over embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import small_batches, table

#: Each component becomes floor(SCALE * x); scores must stay below LARGEST in size.
SCALE, LARGEST = 256, 1 << 63


def sound(vec: Column) -> Column:
    """Not null, and without null, NaN or infinite components (false, never null)."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(vec.isNotNull() & F.forall(vec, finite), F.lit(False))


def numbered(vectors: DataFrame, id_col: str, vector_col: str, *more: Column) -> DataFrame:
    """The rows that take part, written once with a number of their own: ``(row, id, vec, dim, *more)``.

    Rows of one id, or equal rows, stay apart by their number, which no recomputation can change.
    """
    small_batches(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vec"), *more)
    rows = rows.where(sound(F.col("vec")) & F.col("id").isNotNull()).withColumn("row", F.monotonically_increasing_id())
    return table(rows.withColumn("dim", F.size("vec")))


def dealt(rows: Column, blocks: int | Column) -> Column:
    """The block of each row number, evenly."""
    return F.pmod(F.xxhash64(rows), F.lit(blocks) if isinstance(blocks, int) else blocks).cast("int")


def integers(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of equal length as whole-number doubles floor(SCALE * x)."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        return np.floor(SCALE * flat.astype(np.float64)).reshape(len(column), -1)


def largest_score(a: np.ndarray, b: np.ndarray) -> float:
    """A bound on every sum of |a_d * b_d|, the b_d of any rows; raises where scores may not fit a long."""
    if not a.size or not b.size:
        return 0.0
    with np.errstate(over="ignore"):
        bound = float((np.abs(a).max(0) * np.abs(b).max(0)).sum()) * (1 + 1e-9)
    if not bound < LARGEST:
        raise OverflowError("components are too large: inner products may not fit 64 bits")
    return bound
