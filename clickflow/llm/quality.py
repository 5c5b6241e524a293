"""Quality classifier: supervised subword embeddings, averaged per document, softmax output, trained by SGD in numpy.

Every word, every pair of adjacent words (two equal words share one feature) and every run of 3 to 5 characters (code
points) owns a learned vector, found by hash in a table of ``BUCKETS`` rows. A run lies within a word or reaches one
space beyond its borders, and white space of any kind counts as the same. A document is the mean
of its features' vectors; a softmax layer over two classes gives its score. Learning runs in one task over at most
``SAMPLE`` labelled rows, those of smallest hash of their id, and of these, in that order, over whole texts until
``SAMPLE_BYTES`` are reached: documented bounds, so its cost and memory do not grow. The rows are chosen by id, hash
and length alone. As the mean and the layer are linear, scoring needs only each row's product
with the difference of the two output vectors: one megabyte, sent to the tasks, which score whole texts in one pass over
their bytes without any shuffle.

Null and empty texts have no features and score the prior of the learned rows. Without labelled rows of both classes the
score is the share of label 1 (0.5 without any). Labels that are null or neither 0 nor 1 are ignored; of several labels
of one id the smallest holds. Rows are scored independently; repeated rows give repeated results, and are learned from
once. An empty table gives an empty result, and a model without features.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.llm import hashing as H
from clickflow.llm.common import give_back, lean, small_batches, text_pieces

#: Bytes of text in one numpy pass; a longer document is one pass of its own.
_PASS_BYTES = 1 << 18
#: Bytes of text that are learned from: the row that reaches them is the last.
SAMPLE_BYTES = 64 << 20
#: Labelled rows that are learned from at most; rows of the table; length of a vector; passes; step size.
SAMPLE, BITS, WIDTH, EPOCHS, RATE = 6000, 18, 8, 6, 0.5
BUCKETS = 1 << BITS
THRESHOLD = 0.3
_VALUES = H.BYTE.copy()
_VALUES[H.IS_SPACE] = H.BYTE[32]


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    return ((h * H.STEPS[kind]) >> np.uint64(64 - BITS)).astype(np.int32)


def _features(buf: np.ndarray, offsets: np.ndarray):
    """Arrays (bucket, place in the buffer) for words, word pairs and character runs; places are in order in each."""
    starts, ends, at = H.spans(buf, offsets)
    words = H.run_hashes(buf, starts, ends)
    yield _bucket(words, 1), starts
    if len(words) > 1:
        pair = np.where(words[1:] == words[:-1], np.uint64(1), words[:-1] * H.STEPS[2] + words[1:])
        first = np.zeros(len(words), bool)
        first[at[:-1][at[:-1] < len(words)]] = True
        yield _bucket(pair, 3)[~first[1:]], starts[1:][~first[1:]]
    up, down = H.powers(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_VALUES[buf] * down[: len(buf)], out=sums[1:])
    space = H.IS_SPACE[buf]
    spaces = np.zeros(len(buf) + 1, np.int32)
    np.cumsum(space, out=spaces[1:])
    # characters start at every byte that is not a continuation byte of UTF-8
    at_char = np.append(np.flatnonzero((buf & 0xC0) != 0x80), len(buf)).astype(np.int32)
    n_chars = len(at_char) - 1
    text_end = np.searchsorted(at_char, offsets).astype(np.int32)  # in characters
    owner_end = np.repeat(text_end[1:], np.diff(text_end))
    spaces = spaces[at_char]
    for n in (3, 4, 5):
        if n_chars < n:
            break
        i = np.arange(n_chars - n + 1, dtype=np.int32)
        # no space between the first and the last character
        inside = (spaces[n - 1 : n_chars] == spaces[1 : n_chars - n + 2]) & (i + n <= owner_end[: len(i)])
        i = i[inside]
        first, last = at_char[i], at_char[i + n]
        yield _bucket((sums[last] - sums[first]) * up[first], n + 1), first


def _document_features(column: pa.Array):
    """(distinct buckets, their shares) of each text."""
    for first, end, buf, offsets in text_pieces(column, _PASS_BYTES):
        parts = list(_features(buf, offsets)) if len(buf) else []
        for a, b in zip(offsets, offsets[1:]):
            ids = [f[np.searchsorted(p, a) : np.searchsorted(p, b)] for f, p in parts]
            ids = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            at, n = np.unique(ids, return_counts=True)
            yield at, (n / max(len(ids), 1)).astype(np.float32)


def learn(column: pa.Array, labels: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """(table of logits, bias) from texts and 0/1 labels by stochastic gradient descent."""
    rng = np.random.default_rng(seed)
    table = ((rng.random((BUCKETS, WIDTH)) - 0.5) / WIDTH).astype(np.float32)
    out, bias = np.zeros((WIDTH, 2), np.float32), np.zeros(2, np.float32)
    rows = list(_document_features(column))
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for r in rng.permutation(len(rows)):
            at, share = rows[r]
            rate = RATE * (1 - done / steps)
            done += 1
            vectors = table[at]
            mean = share @ vectors
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[r]] -= 1
            # shares are small: each vector's step is scaled by the largest share instead of its own sum
            back = out @ p
            out -= rate * np.outer(mean, p)
            bias -= rate * 0.1 * p
            if len(at):
                table[at] = vectors - np.float32(rate) * share[:, None] * back * np.float32(1 / max(float(share.max()), 1e-3))
    return (table @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES,
) -> tuple[np.ndarray, float]:
    """The model learned from at most ``sample`` of ``labels`` (rows of ``(id_col, label_col)``), up to ``sample_bytes``."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.min(label_col).alias("__label"))
    known = known.orderBy(F.xxhash64("__id"), "__id").limit(sample)
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(F.broadcast(known), "__id")
    texts = texts.withColumn("__hash", F.coalesce(F.md5("__text"), F.lit("")))
    # rows of one id that differ are all learned from, up to the bounds
    order = ["__of", "__id", "__hash"]
    sizes = texts.groupBy("__id", "__hash").agg(F.first(F.coalesce(F.octet_length("__text"), F.lit(0)).cast("long")).alias("__bytes"))
    sizes = sizes.withColumn("__of", F.xxhash64("__id")).orderBy(*order).limit(sample)
    before = F.sum("__bytes").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    # at most ``sample`` rows of ids and hashes: a bounded window and a bounded broadcast
    chosen = sizes.withColumn("__before", F.coalesce(before, F.lit(0))).where(F.col("__before") < sample_bytes).select("__id", "__hash")
    rows = texts.join(F.broadcast(chosen), ["__id", "__hash"]).groupBy("__id", "__hash", "__label").agg(F.first("__text").alias("__text"))
    rows = rows.select(F.xxhash64("__id").alias("__of"), *rows.columns)

    def run(batches):
        got = [b for b in batches if b.num_rows]
        if got:
            t = pa.Table.from_batches(got).sort_by([("__of", "ascending"), ("__id", "ascending"), ("__hash", "ascending")])
            y, texts = t["__label"].to_numpy().astype(np.int64), t["__text"].combine_chunks()
            del got, t
            if 0 < y.sum() < len(y):
                table, bias = learn(texts, y)
            else:
                table, bias = np.zeros(BUCKETS, np.float32), 40.0 * (2 * float(y.mean()) - 1)
            del texts
            give_back()
            yield pa.RecordBatch.from_arrays([pa.array([table.tobytes()], pa.binary()), pa.array([bias], pa.float64())], names=["t", "b"])

    made = rows.coalesce(1).mapInArrow(run, "t binary, b double").collect()
    if not made:
        return np.zeros(BUCKETS, np.float32), 0.0
    return np.frombuffer(bytes(made[0]["t"]), np.float32), float(made[0]["b"])


def scores(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``(id_col, score)`` of each row; with ``keep``, these columns of ``docs`` and ``score``."""
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)
    keep = keep or [id_col]
    # a text that is kept is sent once
    asked = keep if text_col in keep else [*keep, text_col]
    place = asked.index(text_col)
    narrow = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(asked)))
    types = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))

    def run(batches):
        table, bias = sent.value
        for batch in batches:
            logits = [np.zeros(0)]
            for first, end, buf, offsets in text_pieces(batch.column(place), _PASS_BYTES):
                total, n = np.zeros(end - first), np.zeros(end - first)
                for f, at in _features(buf, offsets) if len(buf) else ():
                    run_sums = np.zeros(len(f) + 1)
                    np.cumsum(table[f], out=run_sums[1:], dtype=np.float64)
                    cut = np.searchsorted(at, offsets)
                    total += run_sums[cut[1:]] - run_sums[cut[:-1]]
                    n += cut[1:] - cut[:-1]
                logits.append(total / np.maximum(n, 1) + bias)
            score = 1 / (1 + np.exp(-np.clip(np.concatenate(logits), -60, 60)))
            columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(score)], names=[*(f"c{i}" for i in range(len(keep))), "score"])

    out = narrow.mapInArrow(lean(run), f"{types}, score double")
    return out.toDF(*keep, "__score" if "score" in keep else "score")


def held_out(id_col: Column) -> Column:
    """True for ids whose crc32 (of the id as text) is a multiple of five; a null id is not."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(5)) == 0, F.lit(False))
