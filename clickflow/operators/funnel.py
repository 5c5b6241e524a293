"""Page funnel: adjacent page pairs inside sessions and the conversion along a flow.

``page_transitions`` does not sort whole sessions in one window: a session holding a
third of all actions would then sit in one task. Each session is cut into chunks of
``CHUNK_SECONDS`` (a deterministic key, so any re-evaluation agrees); pairs inside a chunk
come from a window over (session, chunk), and the pair that crosses from one chunk to
the next is stitched from the first and last row of each chunk only. A hot session
is spread over as many tasks as it has busy hours, and its stitch input is two rows per
busy hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.functions.numbers import ratio_half_up
from clickflow.functions.timefmt import parse_time
from clickflow.params import TaskParams
from clickflow.sources.literal import local_table

CHUNK_SECONDS = 3600


def page_transitions(actions: DataFrame) -> DataFrame:
    """Adjacent page pairs inside each session, ordered by action time, then event id.

    Columns: session_id, from_event_id, from_page_id, to_page_id. A table without event ids is ordered by page id
    inside one time, and from_event_id holds that page id (-1 for none).
    """
    t = parse_time(F.col("action_time"))
    tie = F.col("event_id") if "event_id" in actions.columns else F.coalesce("page_id", F.lit(-1))
    keyed = actions.select("session_id", tie.alias("event_id"), "page_id", t.alias("t"))
    keyed = keyed.withColumn("chunk", F.expr(f"unix_seconds(t) div {CHUNK_SECONDS}"))
    in_chunk = Window.partitionBy("session_id", "chunk").orderBy("t", "event_id")
    marked = keyed.select(
        "*",
        F.lead("event_id").over(in_chunk).alias("next_event_id"),
        F.lead("page_id").over(in_chunk).alias("next_page_id"),
        F.lag("event_id").over(in_chunk).isNull().alias("is_first"),
    )
    inner = marked.where(F.col("next_event_id").isNotNull()).select(
        "session_id",
        F.col("event_id").alias("from_event_id"),
        F.col("page_id").alias("from_page_id"),
        F.col("next_page_id").alias("to_page_id"),
    )
    # First and last row of every chunk; the last row of a chunk pairs with the
    # first row of the session's next chunk.
    edges = marked.where(F.col("is_first") | F.col("next_event_id").isNull())
    across_w = Window.partitionBy("session_id").orderBy("t", "event_id")
    across = (
        edges.select(
            "session_id",
            "event_id",
            "page_id",
            F.col("next_event_id").isNull().alias("is_last"),
            F.lead("page_id").over(across_w).alias("to_page_id"),
            F.lead("event_id").over(across_w).alias("to_event_id"),
        )
        .where(F.col("is_last") & F.col("to_event_id").isNotNull())
        .select(
            "session_id",
            F.col("event_id").alias("from_event_id"),
            F.col("page_id").alias("from_page_id"),
            "to_page_id",
        )
    )
    return inner.unionByName(across)


def pair_label(a, b):
    return F.concat_ws("_", a.cast("string"), b.cast("string"))


def page_pair_count(transitions: DataFrame, params: TaskParams) -> DataFrame:
    """Count of each target pair of the flow (pairs outside the flow are dropped)."""
    targets = [f"{a}_{b}" for _, a, b in params.page_pairs]
    pair = pair_label(F.col("from_page_id"), F.col("to_page_id"))
    return (
        transitions.where(pair.isin(targets))
        .groupBy("from_page_id", "to_page_id")
        .agg(F.count(F.lit(1)).alias("pair_count"))
        .select(pair_label(F.col("from_page_id"), F.col("to_page_id")).alias("pair"), "from_page_id", "to_page_id",
                "pair_count")
    )


def flow_pairs(spark: SparkSession, params: TaskParams) -> DataFrame:
    """The task's target flow as (position, from page, to page); a parameter table."""
    schema = T.StructType(
        [
            T.StructField("pos", T.IntegerType()),
            T.StructField("from_page_id", T.LongType()),
            T.StructField("to_page_id", T.LongType()),
        ]
    )
    return local_table(spark, params.page_pairs, schema)


def page_conversion_rate(actions: DataFrame, transitions: DataFrame, params: TaskParams) -> DataFrame:
    """Single-jump conversion along the flow: rate₁ = pair₁ / views of the first page,
    rateₙ = pairₙ / pairₙ₋₁. A pair never seen counts 0; a zero denominator gives null.

    One pass: each transition on the flow counts for its own position and, as the
    previous step, for the next one; views of the first page are the previous step
    of position 1. A single aggregate by position gives both counts, so the
    transitions are computed once.
    """
    spark = actions.sparkSession
    flow = flow_pairs(spark, params)  # a literal table, which Spark broadcasts by its known size
    on_flow = transitions.join(flow, ["from_page_id", "to_page_id"], "inner")
    as_steps = on_flow.select(
        F.inline(
            F.array(
                F.struct(F.col("pos").alias("pos"), F.lit(1).alias("cur"), F.lit(0).alias("prev")),
                F.struct((F.col("pos") + 1).alias("pos"), F.lit(0).alias("cur"), F.lit(1).alias("prev")),
            )
        )
    )
    start = actions.where(F.col("page_id") == params.page_flow[0]).select(
        F.lit(1).alias("pos"), F.lit(0).alias("cur"), F.lit(1).alias("prev")
    )
    per_pos = as_steps.unionByName(start).groupBy("pos").agg(
        F.sum("cur").cast("bigint").alias("pair_count"), F.sum("prev").cast("bigint").alias("prev_count")
    )
    zero = F.lit(0).cast("bigint")
    return (
        flow.join(per_pos, "pos", "left")
        .select(
            "pos",
            pair_label(F.col("from_page_id"), F.col("to_page_id")).alias("pair"),
            "from_page_id",
            "to_page_id",
            F.coalesce("pair_count", zero).alias("pair_count"),
            F.coalesce("prev_count", zero).alias("prev_count"),
        )
        .withColumn("convert_rate", ratio_half_up("pair_count", "prev_count"))
    )
