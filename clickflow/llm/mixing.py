"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of ``BLOCK`` documents. With weight w of the whole, its block k may go out from slot
floor(k / w) on and must be out before slot ceil((k + 1) / w); of the released blocks the one with the earliest deadline
goes first. The weights sum to 1, so a slot is never empty while no source has run out, no deadline is missed, and after
any number t of slots every source has sent between t * w - 1 and t * w + 1 blocks. Weights are whole numbers, so the
schedule repeats after their sum: one period of slots is computed, whose length is the sum of the weights (at most
``PERIOD``), and block k of a source finds its slot by arithmetic. A source that runs out leaves its slots empty; the
others keep their order. Every row is placed; none is repeated or left out.

A row's place in its source is its rank by the md5 of its id, which shuffles the source. Ranks come from counts of
``16 ** 3`` prefixes of that hash and a rank inside each prefix, so a source with a third of all rows is spread over 4,096
groups. Sources that have no weight, and null, share the group ``other`` with ``other_weight``. Rows of one id, null ids
included, stand next to each other. An empty table gives an empty result. Texts are moved, never looked at. Other columns
may have any name: rows are packed while they are placed; only ``mix`` puts its own columns in the place of equal names.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK, PERIOD = 64, 100_000
OTHER = "other"
ADDED = ("__group", "__block", "__slot", "__place")


def period(weights: dict[str, int]) -> list[tuple[str, int, int]]:
    """``(source, block of the period, slot)`` of one period, earliest deadline first among released blocks."""
    total = sum(weights.values())
    if not weights or min(weights.values()) < 1 or total > PERIOD:
        raise ValueError(f"weights must be whole numbers from 1 on whose sum is at most {PERIOD}")
    waiting = [(0, -(-total // w), s, 0) for s, w in sorted(weights.items())]  # (release, deadline, source, block)
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    out = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, deadline, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, s, k))
        deadline, s, k = heapq.heappop(ready)
        if slot >= deadline:
            raise AssertionError("a deadline was missed")
        out.append((s, k, slot))
        if k + 1 < weights[s]:
            w = weights[s]
            heapq.heappush(waiting, ((k + 1) * total // w, -(-(k + 2) * total // w), s, k + 1))
    return out


def _placed(
    docs: DataFrame, kept: list[str], weights: dict[str, int], other_weight: int = 1, block: int = BLOCK, id_col: str = "doc_id", source_col: str = "source"
) -> DataFrame:
    """``__row`` (the columns ``kept`` as a struct), ``__group``, ``__block``, ``__slot``, ``__place``."""
    spark = docs.sparkSession
    weights = dict(weights) | {OTHER: other_weight}
    total = sum(weights.values())
    named = [w for w in weights if w != OTHER]
    source = F.col(source_col)
    group = F.when(source.isin(named), source).otherwise(F.lit(OTHER)) if named else F.lit(OTHER)
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    row = F.struct(*(F.col(f"`{c}`") for c in kept))
    rows = docs.select(row.alias("__row"), group.alias("__group"), digest.alias("__h"), F.substring(digest, 1, 3).alias("__p"))
    # rows before a prefix in its group: 4,096 counts for each group at most
    counts = rows.groupBy("__group", "__p").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__group").orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    inside = Window.partitionBy("__group", "__p").orderBy("__h")
    ranked = rows.withColumn("__r", F.row_number().over(inside) - 1)
    # both tables are bounded: groups * 4,096 counts, and the slots of one period
    ranked = ranked.join(F.broadcast(counts), ["__group", "__p"]).withColumn("__r", F.col("__r") + F.col("__before"))
    ranked = ranked.withColumn("__block", F.expr(f"__r div {block}")).withColumn("__place", F.expr(f"int(__r % {block})"))
    slots = spark.createDataFrame(period(weights), "__group string, __k long, __s long")
    share = spark.createDataFrame(list(weights.items()), "__group string, __w long")
    placed = ranked.join(F.broadcast(share), "__group").withColumn("__k", F.expr("__block % __w"))
    placed = placed.join(F.broadcast(slots), ["__group", "__k"])
    placed = placed.withColumn("__slot", F.expr(f"(__block div __w) * {total} + __s"))
    return placed.select("__row", *ADDED)


def mix(docs: DataFrame, weights: dict[str, int], other_weight: int = 1, **options) -> DataFrame:
    """All columns of ``docs`` and ``__group``, ``__block``, ``__slot``, ``__place``.

    The mixed order is (``__slot``, ``__place``); ``__place`` is the row's place in its block.
    """
    kept = [c for c in docs.columns if c not in ADDED]
    return _placed(docs, kept, weights, other_weight, **options).select("__row.*", *ADDED)


def in_mixed_order(docs: DataFrame, weights: dict[str, int], **options) -> DataFrame:
    """The rows of ``docs`` in the mixed order: partitions are ranges of slots, sorted inside."""
    return _placed(docs, docs.columns, weights, **options).orderBy("__slot", "__place").select("__row.*")
