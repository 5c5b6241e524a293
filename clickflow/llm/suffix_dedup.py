"""Removal of repeated substrings by blockwise suffix sorting with a difference cover.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else too. Sorting every suffix of the corpus
would shuffle sixteen bytes for each byte of text, so the suffixes are first dealt into buckets that their own content
names, and buckets that can hold no partner are left out without loss:

1. *Buckets.* The anchor of a window of ``LENGTH`` bytes is its run of ``GRAM`` bytes with the smallest hash (the leftmost
   of equal ones). Equal windows have equal anchors at equal offsets, so the anchor is the bucket of the suffixes that
   start there. Neighbouring windows share anchors: a segment is the stretch of text of all windows of one anchor.
2. *Counts.* Anchors that occur once hold no repeat. A segment that occurs twice is repeated in all its windows.
3. *Sorting.* Buckets with several different segments are sorted, some at a time, ``BUCKET_BYTES`` together. Positions of
   a text whose residue modulo 31 lies in the difference cover form the sample; its suffixes are sorted once and adjacent
   common prefixes give their ranks for every length. Any two suffixes i and j have a shift d < 31 at which both i + d and
   j + d lie in the sample, so they agree in ``LENGTH`` bytes if their first d bytes are equal and the samples at i + d and
   j + d have equal ranks at length ``LENGTH`` - d. Long ties thus cost one look at a rank, and memory is bounded by the
   bucket, not by the ties.
4. *Removal.* Each text finds its repeated windows by (anchor, segment) and drops the bytes they cover.

A bucket of more than ``BUCKET_SEGMENTS`` different segments (a passage in a large share of all documents) is not sorted
in one task: its windows are counted by hash instead, pre-aggregated, which is exact and has no large group.

Null counts as the empty text; texts shorter than ``LENGTH`` stay whole. Each row is a text of its own: repeated rows
remove each other, also under one id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm import hashing as H
from clickflow.llm.common import cut, runs, small_batches, table, text_pieces

LENGTH, GRAM, BUCKET_BYTES, BUCKET_SEGMENTS = 200, 32, 1 << 19, 4096
#: A perfect difference set: every residue modulo 31 is the difference of two members (fixed values).
MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)
_LOW = np.uint64(0xFFFFFFFF)


class Segments:
    """Anchors of a run of texts and the windows [low, high] that each is the anchor of."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
        n = len(buf)
        per_text = np.maximum(np.diff(offsets) - length + 1, 0)
        total = int(per_text.sum())
        empty = np.zeros(0, np.int64)
        self.anchor = self.segment = self.low = self.high = self.text = empty
        if not total:
            return
        gram = min(GRAM, length)
        up, down = H.powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(H.BYTE[buf] * down[:n], out=sums[1:])
        grams = H.mix((sums[gram:] - sums[: n - gram + 1]) * up[: n - gram + 1])
        least = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
        width, span = length - gram + 1, 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if width > span:
            least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
        starts = np.repeat(offsets[:-1] - np.cumsum(per_text) + per_text, per_text) + np.arange(total)
        at = (least[starts] & _LOW).astype(np.int64)
        new = np.ones(total, bool)
        new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], total) - 1
        self.low, self.high = starts[first], starts[last]
        place = at[first]
        self.anchor = grams[place].view(np.int64)
        whole = H.mix((sums[self.high + length] - sums[self.low]) * up[self.low])
        shape = (place - self.low).astype(np.uint64) * H.STEPS[1] + (self.high - self.low).astype(np.uint64) * H.STEPS[2]
        self.segment = H.mix(whole + shape).view(np.int64)
        self.text = np.searchsorted(offsets, self.low, "right") - 1


def repeated_windows(buf: np.ndarray, starts: np.ndarray, windows: np.ndarray, residues: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which windows of these segments occur twice among them.

    ``buf`` holds the segments one after the other: segment s has ``windows[s]`` windows from ``starts[s]`` on and
    ``windows[s] + length - 1`` bytes; ``residues[s]`` is its place in its text. Returns a flag for each window in order.
    """
    sizes = windows + length - 1
    inside = np.arange(len(buf)) - np.repeat(starts, sizes)
    residue = (np.repeat(residues, sizes) + inside) % MODULUS
    covered = np.zeros(MODULUS, bool)
    covered[list(COVER)] = True
    sample = np.flatnonzero(covered[residue])
    padded = np.concatenate([buf, np.zeros(length, np.uint8)])
    # suffixes of the sample as strings of `length` bytes, sorted once
    strings = np.lib.stride_tricks.sliding_window_view(padded, length)[sample]
    order = strings.view(f"S{length}").ravel().argsort(kind="stable")
    ranked = strings[order]
    differ = ranked[1:] != ranked[:-1]
    common = np.where(differ.any(1), differ.argmax(1), length)
    rank = np.zeros(len(buf), np.int64)
    rank[sample[order]] = np.arange(len(order))
    begin = np.repeat(starts, windows) + (np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows))
    found = np.zeros(len(begin), bool)
    bucket_residue = residue[begin]
    for shift in range(MODULUS):
        mine = np.flatnonzero(covered[(bucket_residue + shift) % MODULUS])
        if not len(mine):
            continue
        tie = np.append(0, np.cumsum(common < length - shift))[rank[begin[mine] + shift]]
        key = H.run_hashes(buf, begin[mine], begin[mine] + shift) + H.mix(tie.astype(np.uint64) * H.STEPS[3])
        _, back, n = np.unique(key, return_inverse=True, return_counts=True)
        found[mine[n[back] > 1]] = True
    return found


def _ranges(flags: np.ndarray) -> list[int]:
    """Runs of set flags as [from, to, from, to, ...], ends excluded."""
    step = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    return np.stack([np.flatnonzero(step == 1), np.flatnonzero(step == -1)], 1).ravel().tolist()


def _anchors(docs: DataFrame) -> DataFrame:
    """(id, anchor, segment, n) for each text and each of its distinct segments."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for first, _, buf, offsets in text_pieces(batch.column(1), 1 << 18):
                s = Segments(buf, offsets)
                if len(s.low):
                    key = H.mix(s.anchor.view(np.uint64) + s.text.astype(np.uint64) * H.STEPS[4]) + s.segment.view(np.uint64)
                    _, at, n = np.unique(key, return_index=True, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(first + s.text[at])), pa.array(s.anchor[at]), pa.array(s.segment[at]), pa.array(n)],
                        names=["id", "anchor", "segment", "n"],
                    )

    return docs.mapInArrow(run, f"id {id_type}, anchor long, segment long, n long")


def _bytes(docs: DataFrame) -> DataFrame:
    """Text (id, text, sorted, counted: anchors) as segments (anchor, segment, residue, windows, bytes, hashes)."""

    def run(batches):
        for batch in batches:
            for first, end, buf, offsets in text_pieces(batch.column(0), 1 << 18):
                s = Segments(buf, offsets)
                rows: list[tuple] = []
                seen: set = set()
                at = np.searchsorted(s.text, np.arange(end - first + 1))
                for i in range(end - first):
                    mine = np.arange(at[i], at[i + 1])
                    for column, hashed in ((1, False), (2, True)):
                        asked = batch.column(column)[first + i].values
                        if asked is None or not len(asked):
                            continue
                        for k in mine[np.isin(s.anchor[mine], asked.to_numpy())].tolist():
                            if (name := (int(s.anchor[k]), int(s.segment[k]))) in seen:
                                continue
                            seen.add(name)
                            low, high = int(s.low[k]), int(s.high[k])
                            if hashed:
                                w = np.arange(low, high + 1) - low
                                part = buf[low : high + LENGTH]
                                rows.append((*name, 0, len(w), None, H.run_hashes(part, w, w + LENGTH).view(np.int64)))
                            else:
                                rows.append((*name, (low - int(offsets[i])) % MODULUS, high - low + 1, buf[low : high + LENGTH].tobytes(), None))
                if rows:
                    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["anchor", "segment", "residue", "windows", "bytes", "hashes"])

    return docs.mapInArrow(run, "anchor long, segment long, residue long, windows long, bytes binary, hashes array<long>")


def _sorted_buckets(segments: DataFrame) -> DataFrame:
    """(anchor, segment, ranges) of segments with repeated windows; whole buckets are sorted together."""

    def groups(batches) -> Iterator[pa.Table]:
        held, size = [], 0
        for bucket in runs(batches, 1):
            held.append(bucket)
            size += sum(c.nbytes for c in bucket["bytes"].chunks)
            if size >= BUCKET_BYTES:
                yield pa.concat_tables(held)
                held, size = [], 0
        if held:
            yield pa.concat_tables(held)

    def run(batches):
        for g in groups(batches):
            windows, residues = g["windows"].to_numpy(), g["residue"].to_numpy()
            buf = np.frombuffer(b"".join(g["bytes"].to_pylist()), np.uint8)
            sizes = windows + LENGTH - 1
            flags = repeated_windows(buf, np.cumsum(sizes) - sizes, windows, residues)
            at = np.append(0, np.cumsum(windows))
            ranges = [_ranges(flags[a:b]) for a, b in zip(at, at[1:])]
            some = pa.array([bool(r) for r in ranges])
            out = pa.table({"anchor": g["anchor"], "segment": g["segment"], "ranges": pa.array(ranges, pa.list_(pa.int32()))})
            yield from out.filter(some).to_batches()

    dealt = segments.select("anchor", "segment", "residue", "windows", "bytes").repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, "anchor long, segment long, ranges array<int>")


def _counted_buckets(segments: DataFrame) -> DataFrame:
    """The same for buckets of very many segments, by counting the hashes of their windows."""
    each = segments.select("anchor", "segment", F.posexplode("hashes").alias("at", "w"))
    often = each.groupBy("anchor", "w").agg(F.count("*").alias("n")).where("n > 1").select("anchor", "w")
    hit = each.join(often, ["anchor", "w"]).groupBy("anchor", "segment").agg(F.collect_list("at").alias("ats"))
    return hit.select("anchor", "segment", F.flatten(F.transform("ats", lambda a: F.array(a, a + 1))).alias("ranges"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_segments: int = BUCKET_SEGMENTS) -> DataFrame:
    """One row for each row: ``(id_col, kept binary, n_bytes, n_removed, n_spans, kept_sha256)``.

    ``kept`` is what is left of the text's bytes (a cut may fall inside a character).
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    small_batches(docs.sparkSession)
    anchors = table(_anchors(narrow))
    twice = anchors.groupBy("anchor").agg(F.sum("n").alias("all")).where(F.col("all") > 1).select("anchor")
    held = table(anchors.join(twice, "anchor"))
    kinds = held.groupBy("anchor", "segment").agg(F.sum("n").alias("n"))
    several = cut(kinds.groupBy("anchor").agg(F.count("*").alias("segments")).where("segments > 1"))
    asked = held.join(several, "anchor").groupBy(F.col("id").alias("wid")).agg(
        F.collect_set(F.when(F.col("segments") <= bucket_segments, F.col("anchor"))).alias("to_sort"),
        F.collect_set(F.when(F.col("segments") > bucket_segments, F.col("anchor"))).alias("to_count"),
    )
    wanted = narrow.join(asked, F.col("id").eqNullSafe(F.col("wid"))).select("text", "to_sort", "to_count")
    found = _bytes(wanted).groupBy("anchor", "segment").agg(*(F.any_value(c).alias(c) for c in ("residue", "windows", "bytes", "hashes")))
    found = table(found)
    partly = _sorted_buckets(found.where("bytes IS NOT NULL")).unionByName(_counted_buckets(found.where("hashes IS NOT NULL")))
    whole = kinds.where("n > 1").select("anchor", "segment")
    known = whole.withColumn("ranges", F.lit(None).cast("array<int>")).unionByName(partly.join(whole, ["anchor", "segment"], "left_anti"))
    marks = held.select("id", "anchor", "segment").distinct().join(known, ["anchor", "segment"])
    marks = marks.groupBy(F.col("id").alias("wid")).agg(F.collect_list(F.struct("anchor", "segment", "ranges")).alias("marks"))

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for first, end, buf, offsets in text_pieces(batch.column(1), 1 << 18):
                s = None
                for i in range(end - first):
                    a, b = int(offsets[i]), int(offsets[i + 1])
                    mark = batch.column(2)[first + i].values
                    body = buf[a:b]
                    if mark is not None and len(mark):
                        s = s or Segments(buf, offsets)
                        gone = _covered(s, i, a, b, mark)
                        step = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
                        kept, removed, spans = body[~gone].tobytes(), int(gone.sum()), int((step == 1).sum())
                    else:
                        kept, removed, spans = body.tobytes(), 0, 0
                    out.append((kept, b - a, removed, spans, hashlib.sha256(kept).hexdigest()))
            types = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            columns = [pa.array(c, t) for c, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = narrow.join(marks, F.col("id").eqNullSafe(F.col("wid")), "left").select("id", "text", "marks")
    schema = f"id {id_type}, kept binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _covered(s: Segments, i: int, a: int, b: int, mark: pa.StructArray) -> np.ndarray:
    """Flags of the bytes [a, b) of text i that a repeated window covers."""
    mine = slice(*np.searchsorted(s.text, [i, i + 1]))
    known = H.mix(mark.field(0).to_numpy().view(np.uint64)) + mark.field(1).to_numpy().view(np.uint64)
    own = H.mix(s.anchor[mine].view(np.uint64)) + s.segment[mine].view(np.uint64)
    order = known.argsort()
    at = order[np.minimum(np.searchsorted(known, own, sorter=order), len(known) - 1)]
    ranges = mark.field(2)
    change = np.zeros(b - a + 1, np.int64)
    low, high = s.low[mine] - a, s.high[mine] - a
    hit = np.flatnonzero(known[at] == own)
    partial = ranges.is_valid().to_numpy(zero_copy_only=False)[at[hit]]
    full = hit[~partial]
    np.add.at(change, low[full], 1)
    np.add.at(change, high[full] + LENGTH, -1)
    for k in hit[partial].tolist():
        r = ranges[int(at[k])].values.to_numpy()
        np.add.at(change, low[k] + r[::2], 1)
        np.add.at(change, low[k] + r[1::2] - 1 + LENGTH, -1)
    return np.cumsum(change[:-1]) > 0
