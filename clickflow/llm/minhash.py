"""MinHash near-dedup by fast similarity sketching, banding and exact verification.

Sketch: rounds 0..t-1 throw every shingle into a random one of t bins, rounds t..2t-1 throw all of them into bin
``round - t``; a bin keeps the smallest (round, value) that reached it, so every coordinate is filled and equals that of
another set with probability equal to their Jaccard similarity, with concentration around it.

Plan: equal sets collapse into one class first. Classes meet in bands. In each bucket the member whose buckets are
fullest in total is the hub (the base text of a group of edited copies), and members are verified against hubs; then
components are built, and classes that share a bucket across different components are verified too, if their sketches
agree in ``AGREEING`` coordinates or more. So a group of n copies costs about n verifications, and no likely link between
different components is left untested. A pair at similarity 0.8 shares none of 64 bands of eight with a probability of
8e-6, and its sketches agree in fewer than 404 of 512 coordinates, two bits of each compared, with one of about 5e-5;
both fall fast above it.

Results: null or empty texts, and texts without words, have no shingles and link with nothing. Rows of one id are one
document (their links are united). A null id is a document of its own: component null, kept true.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm import hashing as H
from clickflow.llm.common import cut, lean, runs, small_batches, table, text_pieces
from clickflow.llm.components import connected_components

#: Coordinates of a sketch, coordinates of a band, coordinates that must agree (in two bits) before sets are compared.
COORDINATES, BAND_ROWS, AGREEING = 512, 8, 404
#: Members of a bucket that are compared at once; a larger bucket is dealt out as pairs of such tiles.
TILE = 1024

_SEEDS = H.mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def sketch(items: np.ndarray, t: int = COORDINATES) -> np.ndarray:
    """The t coordinates (a power of two) of a non-empty set of 64-bit hashes, each as round << 44 | value."""
    bits = np.uint64(64 - t.bit_length() + 1)
    out = np.full(t, np.iinfo(np.uint64).max, np.uint64)
    open_bins, done = np.ones(t, bool), 0
    while done < 2 * t and open_bins.any():
        # enough rounds at once to fill all bins most of the time, whatever the size of the set
        rounds = np.arange(done, min(2 * t, done + max(1, -(-t * 8 // len(items)))), dtype=np.uint64)[:, None]
        h = H.mix(items[None, :] ^ _SEEDS[rounds])
        bins = np.where(rounds < t, h >> bits, rounds - np.uint64(t)) if rounds[-1, 0] >= t else h >> bits
        packed = np.sort(((bins << bits) | (rounds << np.uint64(44)) | (h & np.uint64((1 << 44) - 1))).ravel())
        bins = (packed >> bits).astype(np.int64)
        first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
        fill = first[open_bins[bins[first]]]
        out[bins[fill]] = packed[fill] & ((np.uint64(1) << bits) - np.uint64(1))
        open_bins[bins[fill]] = False
        done = int(rounds[-1, 0]) + 1
    return out


def bands(coordinates: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """One hash for each band; the band's number is part of it."""
    grid = coordinates.reshape(-1, rows)
    total = np.arange(1, len(grid) + 1, dtype=np.uint64) * H.STEPS[8]
    for i in range(rows):
        total = H.mix(total + grid[:, i] * H.STEPS[i + 1])
    return total


def _lanes(coordinates: np.ndarray) -> np.ndarray:
    """Two bits of each coordinate, 32 coordinates in a long."""
    two = H.mix(coordinates).reshape(-1, 32) & np.uint64(3)
    return np.bitwise_or.reduce(two << (np.arange(32, dtype=np.uint64) * np.uint64(2)), axis=1).view(np.int64)


def text_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The shingle set of each text in turn."""
    for first, end, buf, offsets in text_pieces(column):
        starts, ends, at = H.spans(buf, offsets)
        words = H.run_hashes(buf, starts, ends, H.FOLDED)
        for i in range(end - first):
            yield H.shingles(words[at[i] : at[i + 1]], k)


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """``(id, n, h1, h2, bands, lanes)`` of each row; h1, h2 identify the set, lanes has two bits of each coordinate."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            n, h1, h2, band, lane, seen = [], [], [], [], [], {}
            for s in text_sets(batch.column(1), k):
                n.append(len(s))
                key = (int(np.bitwise_xor.reduce(s)), int(np.add.reduce(s * H.STEPS[9]))) if len(s) else (0, 0)
                h1.append(key[0]), h2.append(key[1])
                if len(s) and (key, len(s)) not in seen:  # copies in a batch share one sketch
                    c = sketch(s)
                    seen[key, len(s)] = bands(c).view(np.int64), _lanes(c)
                both = seen[key, len(s)] if len(s) else (None, None)
                band.append(both[0]), lane.append(both[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), *(pa.array(np.array(x, np.uint64).view(np.int64)) for x in (h1, h2)), *(pa.array(x, pa.list_(pa.int64())) for x in (band, lane))],
                names=["id", "n", "h1", "h2", "bands", "lanes"],
            )

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(lean(run), f"id {id_type}, n long, h1 long, h2 long, bands array<long>, lanes array<long>")


def _agreeing(a: str, b: str) -> F.Column:
    """Coordinates in which two ``lanes`` columns agree."""
    total = F.lit(COORDINATES)
    for i in range(COORDINATES // 32):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        total = total - F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return total


def _across(members: DataFrame, percent: int, agreeing: int) -> DataFrame:
    """``(tile, a, b)``: pairs of one bucket and two components whose sizes and sketches allow the threshold.

    ``members``: (key, a, n, component, lanes, marks, members). A bucket of m members becomes about (m / TILE)**2 / 2
    tasks of two tiles each, so no task holds more than two tiles. A pair leaves only the bucket of its first common band.
    """
    id_type = members.schema["a"].dataType.simpleString()
    tiles = F.ceil(F.col("members") / TILE).cast("int")
    dealt = members.withColumn("t", F.pmod(F.xxhash64("a"), tiles).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), tiles - 1)))
    dealt = dealt.select("key", F.least("t", "o").alias("lo"), F.greatest("t", "o").alias("hi"), "t", "a", "n", "component", "lanes", "marks")
    dealt = dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")

    def run(batches):
        for g in runs(batches, 3):
            ids, comp, n = g["a"].to_numpy(zero_copy_only=False), g["component"].to_numpy(zero_copy_only=False), g["n"].to_numpy()
            lanes = g["lanes"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(ids), -1)
            two = (lanes[:, :, None] >> (np.arange(32, dtype=np.uint64) * np.uint64(2))) & np.uint64(3)
            hot = (two.reshape(len(ids), -1)[:, :, None] == np.arange(4, dtype=np.uint64)).reshape(len(ids), -1).astype(np.float32)
            t, lo, hi = g["t"].to_numpy(), g["lo"][0].as_py(), g["hi"][0].as_py()
            x, y = np.flatnonzero(t == lo), np.flatnonzero(t == hi)
            ok = hot[x] @ hot[y].T >= agreeing
            ok &= (comp[x][:, None] != comp[y][None, :]) & (100 * np.minimum.outer(n[x], n[y]) >= percent * np.maximum.outer(n[x], n[y]))
            i, j = np.nonzero(np.triu(ok, 1) if lo == hi else ok)
            i, j = x[i], y[j]
            marks = g["marks"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            key = g["key"][0].as_py()
            tile = np.int64(H.mix(np.array([key], np.int64).view(np.uint64) + np.uint64(lo) * H.STEPS[5] + np.uint64(hi) * H.STEPS[6]).view(np.int64)[0])
            for c in range(0, len(i), 1 << 16):
                p, q = i[c : c + (1 << 16)], j[c : c + (1 << 16)]
                first = (marks[p] == marks[q]).argmax(1)
                here = (marks[p, first] == key >> 32) & (ids[p] != ids[q])
                p, q = ids[p[here]], ids[q[here]]
                swap = p > q
                kind = g.schema.field("a").type
                columns = [pa.array(np.full(len(p), tile)), pa.array(np.where(swap, q, p), kind), pa.array(np.where(swap, p, q), kind)]
                if len(p):
                    yield pa.RecordBatch.from_arrays(columns, names=["tile", "a", "b"])

    return dealt.mapInArrow(lean(run), f"tile long, a {id_type}, b {id_type}")


def _verified_by_tile(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """As ``_verified`` for ``pairs(tile, a, b)``: a text goes once to each tile that asks for it, not to each pair."""
    id_type = docs.schema[id_col].dataType.simpleString()
    asked = pairs.select("tile", F.col("a").alias("id")).unionByName(pairs.select("tile", F.col("b").alias("id"))).distinct()
    texts = asked.join(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id")
    nothing = F.lit(None).cast(id_type)
    texts = texts.select("tile", F.lit(0).alias("pair"), F.col("id").alias("a"), nothing.alias("b"), "text")
    both = texts.unionByName(pairs.select("tile", F.lit(1).alias("pair"), "a", "b", F.lit(None).cast("string").alias("text")))
    both = both.repartition("tile").sortWithinPartitions("tile", "pair")

    def run(batches):
        for g in runs(batches, 1):
            n = int((g["pair"].to_numpy() == 0).sum())
            a, b = g["a"].to_pylist(), g["b"].to_pylist()
            sets: dict = {}
            for name, s in zip(a[:n], text_sets(g["text"].slice(0, n), k)):
                sets.setdefault(name, []).append(s)

            def alike(x, y) -> bool:
                same = len(np.intersect1d(x, y, assume_unique=True))
                return 100 * same >= percent * (len(x) + len(y) - same) and same > 0

            good = [i for i in range(n, len(a)) if any(alike(x, y) for x in sets.get(a[i], ()) for y in sets.get(b[i], ()))]
            if good:
                kind = g.schema.field("a").type
                yield pa.RecordBatch.from_arrays([pa.array([c[i] for i in good], kind) for c in (a, b)], names=["a", "b"])

    return both.mapInArrow(lean(run), f"a {id_type}, b {id_type}").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """Those of ``pairs(a, b)`` whose full shingle sets reach the threshold."""
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("a"), F.col(text_col).alias("ta"))

    def run(batches):
        held: dict = {}
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            # an id may come with several texts
            other = pc.not_equal(batch.column(2)[1:], batch.column(2)[:-1]).to_pylist()
            fresh = [i for i, x in enumerate(a) if i == 0 or x != a[i - 1] or other[i - 1]]
            ta = batch.column(2).take(pa.array(fresh, pa.int64()))
            left, keep, now = iter(text_sets(ta, k)), [], None
            starts = set(fresh)
            for i, s in enumerate(text_sets(batch.column(3), k)):
                if i in starts:
                    now = next(left)
                same = len(np.intersect1d(now, s, assume_unique=True))
                keep.append(same > 0 and 100 * same >= percent * (len(now) + len(s) - same))
            held.clear()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_a = pairs.join(texts, "a")
    both = with_a.join(texts.select(F.col("a").alias("b"), F.col("ta").alias("tb")), "b").select("a", "b", "ta", "tb")
    return both.mapInArrow(lean(run), f"a {id_type}, b {id_type}").distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
    agreeing: int = AGREEING,
) -> DataFrame:
    """One row for each input row: ``(id_col, n_shingles, component_id, kept)``."""
    small_batches(docs.sparkSession)
    sig = table(signatures(docs, id_col, text_col, shingle_words))
    named = sig.where("n > 0 AND id IS NOT NULL")
    classes = named.groupBy("h1", "h2", "n").agg(F.min("id").alias("rep"))
    reps = named.join(classes.select("h1", "h2", "n", F.col("rep").alias("id")), ["h1", "h2", "n", "id"], "left_semi")
    keys = reps.select(F.col("id").alias("rep"), "n", F.explode("bands").alias("key")).distinct()
    sizes = keys.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    members = table(keys.join(sizes, "key"))
    fullness = members.groupBy("rep").agg(F.sum("members").alias("full"))
    ranked = members.join(fullness, "rep").select("key", "rep", "n", "full")
    hubs = ranked.groupBy("key").agg(F.max_by(F.struct("rep", "n"), F.struct("full", "n", "rep")).alias("hub"))
    hubs = hubs.select("key", F.col("hub.rep").alias("hub"), F.col("hub.n").alias("nb"))
    alike = f"100 * least(n, nb) >= {percent} * greatest(n, nb)"
    # an id with several texts may stand for several classes, each with a sketch of its own
    lanes = reps.groupBy(F.col("id").alias("rep"), "n", "h1", "h2").agg(F.first("lanes").alias("lanes"), F.first("bands").alias("bands")).drop("h1", "h2")
    marks = F.transform("bands", lambda b: F.shiftright(b, 32).cast("int"))

    def likely(pairs: DataFrame) -> DataFrame:
        drawn = lanes.select("rep", "lanes")
        both = pairs.join(drawn.toDF("a", "la"), "a").join(drawn.toDF("b", "lb"), "b")
        return both.where(_agreeing("la", "lb") >= agreeing).select("a", "b").distinct()

    stars = members.join(hubs, "key").where(F.expr(alike) & F.expr("rep != hub"))
    stars = cut(likely(stars.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()))
    links = cut(_verified(stars, docs, id_col, text_col, shingle_words, percent))

    comp = connected_components(links, "a", "b")
    placed = members.join(comp.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi")
    placed = placed.join(mixed.select("key"), "key").join(lanes, ["rep", "n"]).withColumn("marks", marks).withColumnRenamed("rep", "a")
    across = _across(placed, percent, agreeing)
    rest = cut(across.join(stars, ["a", "b"], "left_anti"))
    more = cut(_verified_by_tile(rest, docs, id_col, text_col, shingle_words, percent))
    # links between two row versions of one id make no edge; copies join their class's document
    copies = named.join(classes, ["h1", "h2", "n"]).where("id != rep").select(F.col("id").alias("a"), F.col("rep").alias("b")).distinct()
    versions = named.groupBy("id").agg(F.count_distinct("h1", "h2", "n").alias("v")).where("v > 1").select("id")
    tied = copies.join(versions.withColumnRenamed("id", "a"), "a", "left_semi")
    # the links found later tie whole components together
    named_by = lambda c, to: comp.select(F.col("node").alias(c), F.col("component").alias(to))
    late = more.unionByName(tied).join(named_by("a", "ca"), "a", "left").join(named_by("b", "cb"), "b", "left")
    late = connected_components(late.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")), "a", "b")
    of_class = classes.join(named_by("rep", "c"), "rep", "left").withColumn("c", F.coalesce("c", "rep"))
    of_class = of_class.join(late.toDF("c", "lower"), "c", "left")
    of_class = of_class.select("h1", "h2", "n", F.coalesce("lower", "c").alias("component"))
    rows = sig.select("id", "n", "h1", "h2").join(of_class, ["h1", "h2", "n"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    component = F.when(F.col("id").isNotNull(), component)
    return rows.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose document is the smallest id of its group; one row for an id that repeats.

    Of an id's different texts the one of smallest md5 stays. Rows with a null id all stay.
    """
    near = near_duplicates(docs, id_col, text_col, **options)
    kept = near.where("kept").where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("__kept")).distinct()
    stay = docs.join(kept, F.col(id_col) == F.col("__kept"), "left_semi")
    versions = docs.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count("*").alias("__rows"), F.min(F.md5(F.coalesce(F.col(text_col), F.lit("")))).alias("__md5"))
    many = versions.where("__rows > 1").select(F.col(id_col).alias("__many"), "__md5")
    stay = stay.join(many, F.col(id_col) == F.col("__many"), "left")
    stay = stay.where(F.col("__md5").isNull() | (F.md5(F.coalesce(F.col(text_col), F.lit(""))) == F.col("__md5"))).drop("__many", "__md5").dropDuplicates([id_col])
    return stay.unionByName(docs.where(F.col(id_col).isNull()))
