"""Full ranking inside groups without putting a whole group in one task.

``row_number() over (partition by g order by o)`` with no limit sorts each group in one task. Here a rank is the number of
rows in earlier pieces plus the row's position in its own piece:

1. a histogram counts the rows of each (group, sort values);
2. rows that tie in their sort values are cut into pieces by the last sort column, at its approximate quantiles, where more
   than ``PIECE`` rows tie;
3. a running sum over the histogram of (group, sort values, piece) gives each piece its first rank;
4. rows are numbered inside their piece only.

All of it is lazy DataFrame code: no action, no checkpoint. The histogram of a group is ordered in one task. It has a row for
each combination of sort values and piece: where the values are counts that add up to c, at most about sqrt(2 c) of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ties up to this many rows are numbered whole; more are cut into about ``PIECES`` pieces at quantiles of this accuracy.
PIECE, PIECES, ACCURACY = 100_000, 256, 4096


def rank_within_groups(df: DataFrame, group_cols: list[str], values: list[Column], tie: str, rank_col: str = "rank", piece: int = PIECE) -> DataFrame:
    """``df`` with ``rank_col`` = 1-based row number inside each group, ``values`` ascending and then ``tie`` ascending.

    A number descends as its negative: ``-F.col("click_count")``. ``tie`` is a number column and unique where all else ties;
    groups, values and ties are not null. With no ``group_cols`` the whole table is one group.
    """
    names = [f"_v{i}" for i in range(len(values))]
    keyed = df.withColumns(dict(zip(names, values)))
    at = [*group_cols, *names]
    quantiles = F.percentile_approx(tie, [i / PIECES for i in range(1, PIECES)], ACCURACY)
    ties = keyed.groupBy(*at).agg(F.count(F.lit(1)).alias("_n"), quantiles.alias("_cuts"))
    large = ties.where(F.col("_n") > piece).select(*at, "_cuts")
    placed = keyed.join(large, at, "left")
    before = F.size(F.filter("_cuts", lambda cut: cut < F.col(tie)))
    placed = placed.withColumn("_piece", F.when(F.col("_cuts").isNull(), 0).otherwise(before)).drop("_cuts")

    counts = placed.groupBy(*at, "_piece").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group_cols).orderBy(*names, "_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*at, "_piece", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))

    local = Window.partitionBy(*at, "_piece").orderBy(tie)
    ranked = placed.withColumn("_local", F.row_number().over(local)).join(offsets, [*at, "_piece"])
    return ranked.select(*df.columns, (F.col("_offset") + F.col("_local")).alias(rank_col))

