"""Embedding near-dedup with an inverted multi-index and exact verification in double precision.

Unit vectors are cut in two halves; each half has its own codebook (k-means on at most ``SAMPLE`` vectors), and the
product of the two codebooks is a grid of cells. Every vector lives in its nearest cell and visits the cells that the
multi-sequence order names first (by the sum of its two halves' distances), as many as bring ``RECALL`` of the hardest
neighbours: vectors turned from sampled ones by exactly the threshold angle. Where that takes many cells, as in two or
three dimensions, many are visited, if need be all. Inside a visited cell all cosines are taken
as matrix products of doubles; links below the threshold are never reported.

Vectors are compared only inside their label. Equal vectors of a label collapse into one first. A cell is dealt out in
tiles of at most ``TILE`` residents times ``TILE`` visitors, so a hot cell is many tasks of bounded size, and a task
returns one row for each vector (its links and the smallest vector it reaches there), not its pairs.

Vectors that are null, empty or all zero, or hold null, NaN or infinity, rows with a null label and rows with a null id
link with nothing; a null id's component is null. Vectors are compared with those of their own length: each length has
an index of its own, a length of at most ``CELL`` vectors is one cell, and of length 1 all vectors of one sign link.
Every row is a vector of its own and counts its own links, also where ids repeat; components are those of ids, so the
vectors of one id lie in one component. Labels and ids keep their types; labels are equal as Spark's ``=`` has it.
An empty table gives no rows. Indexes are fitted one after another on the driver, on at most ``SAMPLE`` vectors each; more
than ``LENGTHS`` lengths with over ``CELL`` vectors are an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import cut, runs, small_batches, table
from clickflow.llm.components import connected_components

#: Vectors that codebooks are fitted on, and of them for each centre at least; vectors of a cell aimed at; share of
#: neighbours to reach; vectors of a tile's side; lengths that may need an index.
SAMPLE, PER_CENTRE, CELL, RECALL, TILE, LENGTHS = 20_000, 16, 64, 0.99, 1024, 256


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, passes: int = 8) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(passes):
        near = np.concatenate([_distances(x[at : at + 1024], centres).argmin(1) for at in range(0, len(x), 1024)])
        for c in range(k):
            if (mine := near == c).any():
                centres[c] = x[mine].mean(0)
    return centres


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances."""
    return (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)


class MultiIndex:
    """Two codebooks and the number of cells to visit."""

    def __init__(self, sample: np.ndarray, count: int, cosine: float, recall: float = RECALL, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.dim = sample.shape[1]
        self.half = self.dim // 2
        k = max(1, min(-(-len(sample) // PER_CENTRE), int(np.ceil(np.sqrt(count / CELL)))))
        self.k = k
        self.books = _kmeans(sample[:, : self.half], k, rng), _kmeans(sample[:, self.half :], k, rng)
        probes = sample[rng.choice(len(sample), min(len(sample), 2000), replace=False)]
        turn = rng.standard_normal(probes.shape)
        turn -= (turn * probes).sum(1, keepdims=True) * probes
        turn /= np.maximum(np.linalg.norm(turn, axis=1, keepdims=True), 1e-12)
        others = cosine * probes + np.sqrt(1 - cosine * cosine) * turn
        most = min(k * k, 256)
        while True:  # twice as many cells until enough neighbours are reached; all cells reach all
            few = slice(max(100, 500_000 // most))
            probe, other = probes[few], others[few]
            reached = np.cumsum((self.cells(probe, most) == self.cells(other, 1)).sum(0)) / len(probe)
            if reached[-1] >= recall or most == k * k:
                break
            most = min(k * k, 2 * most)
        self.visits = int(np.argmax(reached >= recall)) + 1 if reached[-1] >= recall else most

    def cells(self, x: np.ndarray, visits: int) -> np.ndarray:
        """The first ``visits`` cells of each row in multi-sequence order.

        The cell of ranks (i, j) comes after the (i + 1) * (j + 1) - 1 cells of ranks up to (i, j), so only cells with
        (i + 1) * (j + 1) <= visits can be among the first.
        """
        a, b = _distances(x[:, : self.half], self.books[0]), _distances(x[:, self.half :], self.books[1])
        visits = min(visits, self.k * self.k)
        near_a, near_b = a.argsort(1, kind="stable")[:, :visits], b.argsort(1, kind="stable")[:, :visits]
        a, b = np.take_along_axis(a, near_a, 1), np.take_along_axis(b, near_b, 1)
        i, j = np.array([(i, j) for i in range(near_a.shape[1]) for j in range(near_b.shape[1]) if (i + 1) * (j + 1) <= visits]).T
        first = (a[:, i] + b[:, j]).argsort(1, kind="stable")[:, :visits]
        return np.take_along_axis(near_a[:, i] * self.k + near_b[:, j], first, 1)


def _matrix(column) -> np.ndarray:
    """Rows of equal length as doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Each row times a power of two that brings it near 1, so that no square of a double overflows or vanishes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1]) if x.size else x


def _unit(x: np.ndarray) -> np.ndarray:
    x = _scaled(x)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _spread(found_x: np.ndarray, found_y: np.ndarray, n: int) -> np.ndarray:
    """Smallest index that each of n points reaches over the pairs."""
    label = np.arange(n)
    while len(found_x):
        low = np.minimum(label[found_x], label[found_y])
        new = label.copy()
        np.minimum.at(new, found_x, low)
        np.minimum.at(new, found_y, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _placed(reps: DataFrame, indexes: dict[int, tuple[int, MultiIndex | None]]) -> DataFrame:
    """Each vector with its cells: (key, label, vec, copies, cells); a length's cells are numbered from its first one."""

    def run(batches):
        for batch in batches:
            lengths = np.array(pc.list_value_length(batch.column(2)), np.int64)
            for width in np.unique(lengths):
                part = batch.take(pa.array(np.flatnonzero(lengths == width)))
                first, index = indexes[int(width)]
                cells = np.zeros((len(part), 1), np.int64) if index is None else index.cells(_unit(_matrix(part.column(2))), index.visits)
                cells = (cells + first).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * cells.shape[1]), pa.array(cells.ravel()))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(4)), lists], names=["key", "label", "vec", "copies", "cells"])

    kind = {c: reps.schema[c].dataType.simpleString() for c in ("label", "vec")}
    return reps.mapInArrow(run, f"key long, label {kind['label']}, vec {kind['vec']}, copies long, cells array<int>")


def _indexes(classes: DataFrame, cosine: float) -> dict[int, tuple[int, MultiIndex | None]]:
    """Of each length from 2 on its first cell and its index, which is null where one cell holds all."""
    out, first = {}, 0
    lengths = classes.groupBy(F.size("vec").alias("width")).count().where("count > 1 AND width > 1")
    if (many := lengths.where(F.col("count") > CELL).count()) > LENGTHS:
        raise ValueError(f"{many} lengths need an index of their own; {LENGTHS} may")
    # lengths of few vectors share what follows: a cell each, by their own number
    for width, count in sorted(lengths.collect()):
        index = None
        if count > CELL:
            sample = classes.where(F.size("vec") == width).orderBy(F.xxhash64("h1"), "h1", "h2", F.xxhash64("label")).limit(SAMPLE).select("vec").toArrow()["vec"]
            index = MultiIndex(_unit(_matrix(sample)), count, cosine)
        out[width] = first, index
        first += index.k**2 if index else 1
    return out


def _signed(classes: DataFrame) -> DataFrame:
    """(key, root, links) of the vectors of length 1: the cosine of two of them is 1 or -1."""
    ones = classes.where(F.size("vec") == 1).select("key", "label", "copies", (F.col("vec")[0] > 0).alias("up"))
    groups = ones.groupBy("label", "up").agg(F.min("key").alias("root"), F.sum("copies").alias("all"))
    return ones.join(groups, ["label", "up"]).select("key", "root", (F.col("all") - F.col("copies")).alias("links")).where("links > 0")


def _links(placed: DataFrame, cosine: float) -> DataFrame:
    """(key, root, links) of each vector in each tile pair where it has links."""
    visits = placed.select(F.xxhash64("label").alias("lab"), F.explode("cells").alias("cell"), "key", "label", "vec", "copies", "cells").withColumn("home", F.col("cells")[0])
    sizes = visits.groupBy("lab", "cell").agg(F.sum((F.col("home") == F.col("cell")).cast("long")).alias("nr"), F.count("*").alias("nq"))
    sizes = sizes.where("nr > 0 AND nq > 1").select("lab", "cell", F.expr(f"int(ceil(nr / {TILE}))").alias("tr"), F.expr(f"int(ceil(nq / {TILE}))").alias("tq"))
    rows = visits.join(sizes, ["lab", "cell"])
    mine = F.xxhash64("key")
    asks = rows.select("lab", "cell", F.explode(F.sequence(F.lit(0), F.col("tr") - 1)).alias("r"), F.pmod(mine, F.col("tq")).cast("int").alias("q"), F.lit(True).alias("asks"), "key", "label", "vec", "copies", "cells")
    lives = rows.where("home = cell").select("lab", "cell", F.pmod(mine, F.col("tr")).cast("int").alias("r"), F.explode(F.sequence(F.lit(0), F.col("tq") - 1)).alias("q"), F.lit(False).alias("asks"), "key", "label", "vec", "copies", "cells")
    dealt = asks.unionByName(lives).repartition("lab", "cell", "r", "q").sortWithinPartitions("lab", "cell", "r", "q")

    def run(batches):
        for g in runs(batches, 4):
            asks, key = g["asks"].to_numpy(zero_copy_only=False), g["key"].to_numpy()
            q, r = np.flatnonzero(asks), np.flatnonzero(~asks)
            if not len(q) or not len(r):
                continue
            vec, cells, copies = _scaled(_matrix(g["vec"])), _matrix(g["cells"]).astype(np.int64), g["copies"].to_numpy()
            norm = np.linalg.norm(vec, axis=1)
            i, j = np.nonzero((vec[q] @ vec[r].T) / np.outer(norm[q], norm[r]) >= cosine)
            i, j = q[i], r[j]
            label = g["label"].combine_chunks().dictionary_encode().indices.to_numpy()  # labels may share a hash
            i, j = i[label[i] == label[j]], j[label[i] == label[j]]
            # a pair that meets in both home cells counts in the smaller one, and one of a cell counts once
            home_i, home_j = cells[i, 0], cells[j, 0]
            back = (cells[j] == home_i[:, None]).any(1)
            once = np.where(home_i == home_j, key[i] < key[j], ~back | (home_i < home_j))
            i, j = i[once], j[once]
            if not len(i):
                continue
            ids, at = np.unique(key, return_inverse=True)
            links = np.zeros(len(ids), np.int64)
            np.add.at(links, at[i], copies[j])
            np.add.at(links, at[j], copies[i])
            root = ids[_spread(at[i], at[j], len(ids))]
            some = links > 0
            yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (ids, root, links)], names=["key", "root", "links"])

    return dealt.mapInArrow(run, "key long, root long, links long")


def near_embeddings(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = 0.98) -> DataFrame:
    """One row for each row: ``(id_col, n_links, component_id, kept)``."""
    v, finite = F.col("vec"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    # floats stay floats, all else is compared as doubles
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast(kind).alias("vec"), F.col(label_col).alias("label"))
    sound = v.isNotNull() & (F.size(v) > 0) & F.forall(v, finite) & F.exists(v, lambda x: x != 0)
    sound = F.coalesce(sound, F.lit(False)) & F.col("label").isNotNull() & F.col("id").isNotNull()
    small_batches(vectors.sparkSession)
    keyed = rows.withColumn("ok", sound).withColumns({"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit(1), "vec", F.size("vec"))})
    good = keyed.where("ok")
    classes = good.groupBy("label", "h1", "h2").agg(F.min("id").alias("rid"), F.count("*").alias("copies"), F.any_value("vec").alias("vec"))
    classes = table(classes.withColumn("key", F.monotonically_increasing_id()))  # written, so its numbers stay
    indexes = _indexes(classes, cosine)
    signed = _signed(classes)
    found = signed
    if indexes:
        placed = _placed(classes.where(F.size("vec").isin(*indexes)).select("key", "label", "vec", "copies"), indexes)
        found = _links(placed, cosine).unionByName(signed)
    found = cut(found)
    named = classes.select("key", "rid")
    edges = found.where("key != root").select("key", "root").distinct()
    edges = edges.join(named, "key").join(named.toDF("root", "to"), "root").select("rid", "to")
    found = found.groupBy("key").agg(F.sum("links").alias("links"))
    classes = classes.select("label", "h1", "h2", "key", "rid", "copies")
    # an id with several vectors ties their classes together
    several = good.groupBy("id").agg(F.count_distinct("label", "h1", "h2").alias("n")).where("n > 1").select("id")
    ties = good.join(several, "id", "left_semi").join(classes, ["label", "h1", "h2"]).where("id != rid").select(F.col("rid"), F.col("id").alias("to"))
    comp = connected_components(edges.unionByName(ties), "rid", "to").select(F.col("node").alias("rid"), "component")
    classes = classes.join(found, "key", "left").join(comp, "rid", "left")
    classes = classes.select("label", "h1", "h2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("component", "rid").alias("comp"), F.lit(True).alias("ok"))
    out = keyed.select("id", "label", "h1", "h2", "ok").join(classes, ["label", "h1", "h2", "ok"], "left")
    comp = F.coalesce("comp", "id")
    comp = F.when(F.col("id").isNotNull(), comp)
    return out.select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), comp.alias("component_id"), F.coalesce(F.col("id") == comp, F.lit(True)).alias("kept"))
