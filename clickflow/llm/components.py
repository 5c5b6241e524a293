"""Connected components by alternating large-star and small-star rounds.

No vertex's neighbours are ever gathered: each round is two joins against per-vertex minima, which are
pre-aggregated before their shuffle. A round's edges are cut to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import cut


#: Edges of one partition of a written round.
ROWS = 50_000


def _is_stars(edges: DataFrame) -> bool:
    """Whether every edge leads from a node of one edge only to a node that has no smaller neighbour."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    per_node = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per_node.where("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """``(node, component)`` for every end of an edge; component is the smallest node reachable.

    Ids may be of any ordered type. Edges with a null end, loops and repeated edges change nothing; without
    edges the result is empty.
    """
    a, b = F.col(src), F.col(dst)
    e = edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    e = e.distinct()
    parts = None
    while True:
        e = cut(e if parts is None else e.coalesce(parts))
        parts = max(1, -(-e.count() // ROWS))  # few files for few edges; the rounds never add any
        if _is_stars(e):
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = small.unionByName(lower.select("u", F.col("m").alias("v"))).distinct()
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return roots.unionByName(e.select(F.col("u").alias("node"), F.col("v").alias("component")))
