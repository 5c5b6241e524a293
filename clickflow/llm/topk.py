"""Exact top-k search by inner product with the threshold algorithm over sorted per-dimension lists.

Components are whole numbers (``vectors.integers``). Candidate rows are dealt to blocks of about ``BLOCK`` rows; a block
keeps one list for each dimension, its rows sorted by that component. For a query the lists are walked from the end that
its weight favours, all to the same depth: rows that come up are scored exactly (random access), and the weighted sum of
the components at the depth bounds every row that has not come up. The walk stops when that bound is below the kth best
score. At equality it goes on, since a row with a smaller id may follow. A task walks the ``STRIPE`` blocks of its stripe
one after another and carries each query's kth score along, so later blocks stop sooner; the stripes' results (k rows of
each query) are ranked at the end. No score is approximate and no row is left out but by the bound.

Plan: the numbered rows are written once; queries go once to each stripe, rows once to each block of ``QUERIES`` queries.
A task holds ``QUERIES`` queries and one block with its lists. Pairs grow with queries times rows, as the task states.

Rows with a null id, or a vector that is null or holds null, NaN or infinite components take no part. Vectors meet those
of their own length (empty ones score 0 with each other). A query's own row is left out, other rows of its id are not.
Equal scores rank by smaller id; of repeated rows each takes a rank. Weights of 0 have no list; a query of zeros scores 0
everywhere and gets the smallest ids. Where scores might not fit 64 bits, an OverflowError says so. An empty table, or one
without queries, gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.common import runs
from clickflow.llm.vectors import dealt, integers, largest_score, numbered

#: Rows of a block, blocks that one task walks in turn, queries of a task, depth of the first round of a walk.
BLOCK, STRIPE, QUERIES, FIRST_DEPTH = 4096, 4, 2048, 8


class SortedLists:
    """A block of rows and, for each dimension, its rows in descending order of their component."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, values: np.ndarray):
        order = np.lexsort((rows, ids))
        self.ids, self.rows, self.values = ids[order], rows[order], values[order]
        self.lists = np.argsort(-self.values, axis=0, kind="stable").astype(np.int32)
        self.by_row = np.argsort(self.rows, kind="stable")

    def position(self, row: int) -> int | None:
        """Where the row of that number stands in this block, if it does."""
        at = int(np.searchsorted(self.rows, row, sorter=self.by_row))
        return int(self.by_row[at]) if at < len(self.rows) and self.rows[self.by_row[at]] == row else None

    def walk(self, weights: np.ndarray, k: int, own: int | None, beat: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(positions, scores) of the best k rows, by score and then id, of those that may reach ``beat``."""
        n = len(self.ids)
        up, down = np.flatnonzero(weights > 0), np.flatnonzero(weights < 0)
        seen = np.zeros(n, bool)
        if own is not None:
            seen[own] = True
        if not len(up) and not len(down):
            first = np.flatnonzero(~seen[: k + 1])[:k]
            return first, np.zeros(len(first), np.int64)
        at, scores = np.zeros(0, np.int64), np.zeros(0, self.values.dtype)
        done, depth = 0, FIRST_DEPTH
        while done < n:
            depth = min(depth, n)
            fresh = np.zeros(n, bool)
            fresh[self.lists[done:depth, up]] = True
            fresh[self.lists[n - depth : n - done, down]] = True
            new = np.flatnonzero(fresh & ~seen)
            seen |= fresh
            at, scores = best(np.concatenate([at, new]), np.concatenate([scores, self.values[new] @ weights]), k)
            limits = [scores[-1]] if len(scores) == k else []
            limits += [beat] if beat is not None else []
            bound = weights[up] @ self.values[self.lists[depth - 1, up], up] + weights[down] @ self.values[self.lists[n - depth, down], down]
            if limits and bound < max(limits):
                break
            done, depth = depth, depth * 4
        return at, scores.astype(np.int64)


def best(at: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, equal ones by smaller position."""
    if len(at) > k:
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        at, scores = at[some], scores[some]
    order = np.lexsort((at, -scores))[:k]
    return at[order], scores[order]


def _walked(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The best k rows of each query over the blocks of a stripe; the queries come first, as block -1."""
    asked, key = None, None

    def results():
        for (row, qid), (ids, scores) in zip(asked[0], asked[2]):
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), row)), pa.array(np.full(len(ids), qid)), pa.array(ids), pa.array(scores)], names=["query_row", "query_id", "id", "score"])

    for g in runs(batches, 4):
        dim, queries, stripe, block = (g.column(i)[0].as_py() for i in range(4))
        if (dim, queries, stripe) != key:
            if asked is not None:
                yield from results()
            key, asked = (dim, queries, stripe), None
        rows, ids, values = g["row"].to_numpy(), g["id"].to_numpy(), integers(g["vec"])
        if block < 0:
            asked = list(zip(rows.tolist(), ids.tolist())), values, [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(rows)
        elif asked is not None:
            weights = asked[1]
            if largest_score(weights, values) >= 1 << 53:  # beyond exact doubles: Python's whole numbers
                values, weights = (np.array([[int(x) for x in v] for v in m], object).reshape(m.shape) for m in (values, weights))
            lists = SortedLists(ids, rows, values)
            for i, (row, _) in enumerate(asked[0]):
                held, scores = asked[2][i]
                at, more = lists.walk(weights[i], k, lists.position(row), int(scores[-1]) if len(scores) == k else None)
                if len(at):
                    held, scores = np.concatenate([held, lists.ids[at]]), np.concatenate([scores, more])
                    order = np.lexsort((held, -scores))[:k]
                    asked[2][i] = held[order], scores[order]
    if asked is not None:
        yield from results()


def top_k(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: of each row that ``queries`` names the k other rows of highest score."""
    rows = numbered(vectors, id_col, vector_col, F.coalesce(queries, F.lit(False)).alias("asks"))
    count, asking = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0))).first()
    blocks, parts = -(-count // BLOCK) or 1, -(-asking // QUERIES) or 1
    stripes = -(-blocks // STRIPE)
    block = dealt(F.col("row"), blocks)
    asks = rows.where("asks").select("dim", dealt(F.col("row"), parts).alias("part"), F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"), F.lit(-1).alias("block"), "row", "id", "vec")
    lives = rows.select("dim", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.floor(block / STRIPE).cast("int").alias("stripe"), block.alias("block"), "row", "id", "vec")
    meet = asks.unionByName(lives).repartition("dim", "part", "stripe").sortWithinPartitions("dim", "part", "stripe", "block")
    found = meet.mapInArrow(lambda batches: _walked(batches, k), "query_row long, query_id long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc("id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
