"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

1. quality: documents that the classifier scores below its threshold go;
2. lines: lines of recurring templates go from documents that have other text too;
3. near_dedup: of each group of near-duplicates (five-word shingles, similarity 0.8) the smallest id stays;
4. mixing: the rows are put in the order of the target weights of their sources; none is lost;
5. tokens: texts become token ids, and decoding is checked against the text. A written table has no order of its own, so
   the rows carry their place in the mix as ``mix_group``, ``slot`` and ``place``, and come sorted by ``slot, place``.

All stages but the last return the columns of ``documents``. Null and empty texts pass: they hold nothing to judge.
Edge cases are those of the operators' docstrings.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm import bpe, line_dedup, minhash, mixing, quality
from clickflow.llm.common import read, shared_folder
from clickflow.llm.queries import OTHER_TARGET, TARGET


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").where(~quality.held_out(F.col("doc_id")))
    scored = quality.scores(docs, quality.fit(docs, labels), keep=docs.columns)
    nothing = F.coalesce(F.col("text"), F.lit("")) == ""
    return scored.where(nothing | (F.col(scored.columns[-1]) >= quality.THRESHOLD)).select(*docs.columns)


def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = line_dedup.drop_recurring_lines(docs)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("__dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each_group(docs, shingle_words=5)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.in_mixed_order(docs, TARGET, other_weight=OTHER_TARGET)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # places follow from the ids and sources alone, so they are those of the mixing stage
    placed = mixing.mix(docs.select("doc_id", "source", "text"), TARGET, other_weight=OTHER_TARGET)
    placed = placed.select("doc_id", "text", F.col("__group").alias("mix_group"), F.col("__slot").alias("slot"), F.col("__place").alias("place"))
    # sorted before encoding: a sort samples its input, which would encode the texts twice
    return bpe.encoded(placed.orderBy("slot", "place"), bpe.default_vocabulary(), keep=("mix_group", "slot", "place"))


STAGES = [
    ("quality", good_documents),
    ("lines", without_recurring_lines),
    ("near_dedup", without_near_duplicates),
    ("mixing", mixed_sources),
    ("tokens", as_tokens),
]

#: Learned scores, and merges by rank, have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are a written table in the shared folder."""
    docs = read(spark, sf_dir, "documents")
    base = f"{shared_folder(spark)}/llm/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
