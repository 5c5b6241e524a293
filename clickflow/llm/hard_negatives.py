"""Hard negatives by exact scores from a residue-number-system matrix product, then a window around each positive.

Scores are integer inner products of whole-number components (``vectors.integers``). A product is taken modulo several
primes below 1024: residues lie in -(p-1)/2 .. (p-1)/2, so a sum of ``CHUNK`` products stays below 2**24 and a float32
matrix product is exact. As many primes are used as the largest possible score of the tile needs. The signed score comes
back by Chinese remaindering in mixed radix with symmetric digits, which needs no comparison with the modulus.

Two passes over tiles of at most about ``TILE`` anchors times ``TILE`` rows:

1. anchors meet the rows of their own label; the best ``positives`` of each anchor are its positives;
2. anchors, with the scores of their positives, meet all rows; for each positive the best ``negatives`` of another label
   with ``low`` * positive score <= 100 * score <= ``high`` * positive score.

A tile returns at most that many rows for each anchor (or anchor and positive); they are ranked over all tiles. A hot label
is many tiles, and no tile's scores leave its task. Pairs grow with anchors times rows, as the task states.

Rows with a null id or label, or a vector that is null or holds null, NaN or infinite components take no part. Vectors
meet those of their own length. An anchor's own row is no positive, other rows of its id may be. Equal scores rank by
smaller id; of repeated rows each takes a rank, and repeated positives give repeated results. Positive scores below 0
have no window. Where scores might not fit 64 bits, an OverflowError says so. An empty table, or one without anchors,
gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm.common import runs, table
from clickflow.llm.vectors import dealt, integers, largest_score, numbered

#: Rows of a tile's sides, anchors scored at a time, components summed in float32 before they are reduced.
TILE, STEP, CHUNK = 8192, 256, 64
#: Labels up to which their counts are broadcast (24 bytes each).
FEW_LABELS = 100_000
LOWEST = np.iinfo(np.int64).min
#: Columns of what the tiles of the two passes return, all longs.
NEAR, PAIR = "anchor_row row id score", "anchor_row anchor_id positive_row positive_id positive_score id score"


@cache
def primes() -> tuple[int, ...]:
    """The primes below 1024 whose ``CHUNK`` products of residues stay exact in float32, largest first."""
    found = [p for p in range(3, 1024) if all(p % q for q in range(2, int(p**0.5) + 1))]
    return tuple(p for p in reversed(found) if CHUNK * ((p - 1) // 2) ** 2 < 1 << 24)


def moduli(bound: float) -> tuple[int, ...]:
    """The first primes whose product exceeds twice the bound."""
    product, out = 1, []
    for p in primes():
        out.append(p)
        product *= p
        if product > 2 * int(bound) + 2:
            return tuple(out)
    raise OverflowError("scores beyond every modulus")


def _symmetric(x: np.ndarray, p: int) -> np.ndarray:
    x = np.remainder(x, p)
    return np.where(x > p // 2, x - p, x)


def residues(values: np.ndarray, mods: tuple[int, ...]) -> list[np.ndarray]:
    whole = values.astype(np.int64)
    return [_symmetric(whole, p).astype(np.float32) for p in mods]


def products(a: list[np.ndarray], b: list[np.ndarray], mods: tuple[int, ...]) -> np.ndarray:
    """Exact inner products of the rows of two residue matrices, as int64."""
    digits: list[np.ndarray] = []
    for p, x, y in zip(mods, a, b):
        total = np.zeros((len(x), len(y)), np.float32)
        for at in range(0, x.shape[1], CHUNK):
            part = x[:, at : at + CHUNK] @ y[:, at : at + CHUNK].T
            part -= p * np.rint(part * np.float32(1 / p))
            total += part
            total -= p * np.rint(total * np.float32(1 / p))
        digit = total.astype(np.int32)
        # take away what the digits so far stand for, then divide by their radix, all modulo p
        so_far = np.zeros_like(digit)
        for q, d in zip(reversed(mods[: len(digits)]), reversed(digits)):
            so_far = np.remainder(so_far * (q % p) + d, p)
        radix = 1
        for q in mods[: len(digits)]:
            radix = radix * q % p
        digits.append(_symmetric((digit - so_far) * pow(radix, -1, p), p) if digits else _symmetric(digit, p))
    out = np.zeros(digits[0].shape, np.int64)
    for p, d in zip(reversed(mods), reversed(digits)):
        out *= p  # wraps where the radix passes 64 bits; the score itself fits
        out += d
    return out


def best_allowed(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k highest allowed scores, equal ones by smaller column."""
    if scores.shape[1] > k:
        masked = np.where(allowed, scores, LOWEST)
        allowed = allowed & (scores >= np.partition(masked, masked.shape[1] - k, axis=1)[:, [masked.shape[1] - k]])
    i, j = np.nonzero(allowed)
    order = np.lexsort((j, -scores[i, j], i))
    i, j = i[order], j[order]
    keep = np.arange(len(i)) - np.searchsorted(i, i) < k
    return i[keep], j[keep]


def _tiles(batches: Iterator[pa.RecordBatch], keys: int, select: Callable[[pa.Table, pa.Table, np.ndarray], Iterator[pa.RecordBatch]], step: int) -> Iterator[pa.RecordBatch]:
    """``select(anchors, rows, scores)`` for each tile and step of anchors; the rows come sorted by id."""
    for g in runs(batches, keys):
        anchors, rows = g.filter(g["anchor"]), g.filter(pc.invert(g["anchor"])).sort_by("id")
        if not len(anchors) or not len(rows):
            continue
        a, b = integers(anchors["vec"]), integers(rows["vec"])
        mods = moduli(largest_score(a, b))
        a, b = residues(a, mods), residues(b, mods)
        for at in range(0, len(anchors), step):
            yield from select(anchors.slice(at, step), rows, products([x[at : at + step] for x in a], b, mods))


def _same_label(anchors: pa.Table, rows: pa.Table) -> np.ndarray:
    both = pa.chunked_array([*anchors["label"].chunks, *rows["label"].chunks]).combine_chunks().dictionary_encode()
    codes = both.indices.to_numpy()
    return codes[: len(anchors), None] == codes[None, len(anchors) :]


def _named(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else pa.array(c) for c in columns], names=names.split())


def window(positive: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest whole number between ``low`` and ``high`` percent of scores from 0 on."""
    whole, rest = np.divmod(positive, 100)
    return whole * low - (-rest * low) // 100, whole * high + rest * high // 100


def _ranked(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("id")))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def _positives(rows: DataFrame, k: int, step: int) -> DataFrame:
    """(anchor_row, row, id, score) of the best k rows of each anchor's label."""
    sizes = table(rows.groupBy("label", "dim").agg(F.count("*").alias("n"), F.sum(F.col("asks").cast("long")).alias("na")).where("na > 0"))
    sizes = sizes.select("label", "dim", *(F.ceil(F.col(c) / TILE).cast("int").alias(t) for c, t in (("n", "tr"), ("na", "ta"))))
    here = rows.join(F.broadcast(sizes) if sizes.count() <= FEW_LABELS else sizes, ["label", "dim"])
    key = [F.xxhash64("label").alias("key"), "dim"]
    asks = here.where("asks").select(*key, dealt(F.col("row"), F.col("ta")).alias("a"), F.explode(F.sequence(F.lit(0), F.col("tr") - 1)).alias("r"), F.lit(True).alias("anchor"), "label", "row", "id", "vec")
    lives = here.select(*key, F.explode(F.sequence(F.lit(0), F.col("ta") - 1)).alias("a"), dealt(F.col("row"), F.col("tr")).alias("r"), F.lit(False).alias("anchor"), "label", "row", "id", "vec")
    meet = asks.unionByName(lives).repartition("key", "dim", "a", "r").sortWithinPartitions("key", "dim", "a", "r")

    def select(anchors, rows, scores):
        own = anchors["row"].to_numpy()[:, None] == rows["row"].to_numpy()[None]
        i, j = best_allowed(scores, _same_label(anchors, rows) & ~own, k)
        yield _named(NEAR, anchors["row"].take(i), rows["row"].take(j), rows["id"].take(j), scores[i, j])

    found = meet.mapInArrow(lambda batches: _tiles(batches, 4, select, step), ", ".join(f"{c} long" for c in NEAR.split()))
    return _ranked(found, ["anchor_row"], k)


def mine(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", step: int = STEP,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``; ``low`` and ``high`` in percent."""
    rows = numbered(vectors.where(F.col(label_col).isNotNull()), id_col, vector_col, F.col(label_col).alias("label"), F.coalesce(anchors, F.lit(False)).alias("asks"))
    count, asking = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0))).first()
    tr, ta = -(-count // TILE) or 1, -(-asking // TILE) or 1
    # a positive score below 0 has no window; at most ``positives`` of them make the list of an anchor
    pairs = _positives(rows, positives, step).where("score >= 0").groupBy("anchor_row").agg(F.collect_list(F.struct("row", "id", "score")).alias("wanted"))
    asks = rows.where("asks").join(pairs.withColumnRenamed("anchor_row", "row"), "row")
    asks = asks.select("dim", dealt(F.col("row"), ta).alias("a"), F.explode(F.sequence(F.lit(0), F.lit(tr - 1))).alias("r"), F.lit(True).alias("anchor"), "label", "row", "id", "vec", "wanted")
    lives = rows.select("dim", F.explode(F.sequence(F.lit(0), F.lit(ta - 1))).alias("a"), dealt(F.col("row"), tr).alias("r"), F.lit(False).alias("anchor"), "label", "row", "id", "vec")
    meet = asks.unionByName(lives, allowMissingColumns=True).repartition("dim", "a", "r").sortWithinPartitions("dim", "a", "r")

    def select(anchors, rows, scores):
        other, wanted = ~_same_label(anchors, rows), anchors["wanted"].to_pylist()
        for at in range(max(map(len, wanted))):
            have = [w[at] if at < len(w) else {"row": None, "id": None, "score": -1} for w in wanted]
            p = np.array([w["score"] for w in have], np.int64)
            least, most = window(p, low, high)
            i, j = best_allowed(scores, other & (scores >= least[:, None]) & (scores <= most[:, None]) & (p >= 0)[:, None], negatives)
            positive = (pa.array([have[x][c] for x in i], pa.int64()) for c in ("row", "id"))
            yield _named(PAIR, anchors["row"].take(i), anchors["id"].take(i), *positive, p[i], rows["id"].take(j), scores[i, j])

    found = meet.mapInArrow(lambda batches: _tiles(batches, 3, select, step), ", ".join(f"{c} long" for c in PAIR.split()))
    best = _ranked(found, ["anchor_row", "positive_row"], negatives)
    return best.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
