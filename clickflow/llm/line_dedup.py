"""Line dedup by a log-template tree of fixed depth.

A line (between line feeds) descends by its token count, then by its first ``DEPTH`` tokens, to a leaf; tokens that hold
a digit are variable from the start. Inside a leaf, a token that at least ``MIN_DOCS`` lines have at its place is a fixed
part of the template, any other a variable field, so no line is compared with another and the order of lines doesn't
matter. A template recurs if it stands in ``MIN_DOCS`` documents or more and at least ``FIXED_SHARE`` of its tokens are
fixed; its lines are dropped.

A document of which recurring lines hold more than ``COPY_SHARE`` of the tokens is a copy of other documents, or nothing
but boilerplate: dropping its lines would lose the text in every copy, so it stays whole for near-dedup to judge.

Plan: leaves are counted on hashes alone (a document names each leaf once); only lines of leaves that reach ``MIN_DOCS``
documents are looked at again, as distinct lines, with their tokens as hashes. Every count is pre-aggregated before its
shuffle, so a line that stands in a third of all documents is one row for each task.

A leaf, line or template that holds a large share of all rows is dealt over many partitions where it is joined
(``spread_join``). Rows are told apart by a hash of id and text, so rows of a null or shared id don't meet either.

Null and empty texts have no lines and stay as they are; blank lines are never dropped. Rows of one id are one document
when documents are counted, and each row is rewritten by its own text. A null id counts as one document. An empty table
gives an empty result. A text is read whole, in one pass over its bytes, however long it is. Extra columns are kept; their
names may be those used inside, but for ``__lines``, ``__dropped`` and ``__drop``, ``__key``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm import hashing as H
from clickflow.llm.common import lean, small_batches, spread_join, table, text_pieces

DEPTH, MIN_DOCS, FIXED_SHARE, COPY_SHARE = 3, 5, 0.6, 0.5
_LINE_FEED = 10
_VARIABLE = np.uint64(0x9E3779B97F4A7C15)
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


class Lines:
    """The non-blank lines of a run of texts: tokens as hashes, leaf and line hashes."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, depth: int):
        starts, ends, at = H.spans(buf, offsets)
        digits = np.zeros(len(buf) + 1, np.int32)
        np.cumsum(_DIGIT[buf], out=digits[1:])
        tokens = H.run_hashes(buf, starts, ends)
        tokens[digits[ends] > digits[starts]] = _VARIABLE
        feeds = np.zeros(len(buf) + 1, np.int32)
        np.cumsum(buf == _LINE_FEED, out=feeds[1:])
        line_of = feeds[starts]  # feeds before the token: the same for all tokens of a line
        text_of = np.searchsorted(at, np.arange(len(starts)), "right") - 1
        new = np.ones(len(starts), bool)
        new[1:] = (line_of[1:] != line_of[:-1]) | (text_of[1:] != text_of[:-1])
        self.tokens, self.first = tokens, np.flatnonzero(new)
        self.end = np.append(self.first[1:], len(starts))
        self.text = text_of[self.first]
        #: number of the line in its text
        self.number = line_of[self.first] - feeds[offsets[self.text]]
        n = self.end - self.first
        leaf = H.mix(n.astype(np.uint64) * H.STEPS[1])
        for i in range(depth):
            has = n > i
            leaf[has] = H.mix(leaf[has] * H.STEPS[2] + tokens[self.first[has] + i])
        place = (np.arange(len(starts)) - np.repeat(self.first, n)).astype(np.uint64)
        whole = np.add.reduceat(H.mix(tokens + place * H.STEPS[3]), self.first) if len(self.first) else np.zeros(0, np.uint64)
        self.leaf, self.line, self.n = leaf.view(np.int64), H.mix(whole + leaf).view(np.int64), n


def _leaves(docs: DataFrame, depth: int) -> DataFrame:
    """``(key, leaf)``: the distinct leaves of each row of ``(key, id, text)``."""

    def run(batches):
        for batch in batches:
            for first, end, buf, offsets in text_pieces(batch.column(1)):
                lines = Lines(buf, offsets, depth)
                if len(lines.first):
                    rows, leaves = np.unique(np.stack([lines.text, lines.leaf]), axis=1)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(first + rows)), pa.array(leaves)], names=["key", "leaf"])

    return docs.select("key", "text").mapInArrow(lean(run), "key long, leaf long")


def _candidates(docs: DataFrame, depth: int) -> DataFrame:
    """Distinct lines (of each row) whose leaf is one of the row's ``leaves``."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            wanted = batch.column(3)
            for first, end, buf, offsets in text_pieces(batch.column(2)):
                lines = Lines(buf, offsets, depth)
                part = wanted.slice(first, end - first)
                owner = np.repeat(np.arange(end - first), pc.list_value_length(part).to_numpy(zero_copy_only=False).astype(np.int64))
                asked = np.unique(H.mix(part.flatten().to_numpy().view(np.uint64) + owner.astype(np.uint64) * H.STEPS[5]))
                mine = H.mix(lines.leaf.view(np.uint64) + lines.text.astype(np.uint64) * H.STEPS[5])
                pick = np.flatnonzero(np.isin(mine, asked))
                _, once = np.unique(np.stack([lines.text[pick], lines.line[pick]]), axis=1, return_index=True)
                pick = pick[once]
                if not len(pick):
                    continue
                n = lines.n[pick]
                flat = np.repeat(lines.first[pick] - np.cumsum(n) + n, n) + np.arange(n.sum())
                tokens = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(lines.tokens[flat].view(np.int64)))
                row = pa.array(first + lines.text[pick])
                columns = [batch.column(0).take(row), batch.column(1).take(row), pa.array(lines.leaf[pick]), pa.array(lines.line[pick]), tokens]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "id", "leaf", "line", "tokens"])

    return docs.mapInArrow(lean(run), f"key long, id {id_type}, leaf long, line long, tokens array<long>")


def _row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def recurring_lines(docs: DataFrame, id_col: str, text_col: str, depth: int = DEPTH, min_docs: int = MIN_DOCS, fixed_share: float = FIXED_SHARE) -> DataFrame:
    """``(key, drop array<long>)``: hashes of the lines of each row whose template recurs; the key is that of ``_row_key``."""
    narrow = docs.select(_row_key(id_col, text_col).alias("key"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    small_batches(docs.sparkSession)
    leaves = _leaves(narrow, depth)
    hot = table(leaves.groupBy("leaf").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs))
    wanted = spread_join(leaves, hot, ["leaf"], "docs", "key").groupBy("key").agg(F.collect_set("leaf").alias("leaves"))
    found = table(_candidates(narrow.join(wanted, "key").select("key", "id", "text", "leaves"), depth))
    lines = found.groupBy("leaf", "line").agg(F.count("*").alias("lines"), F.any_value("tokens").alias("tokens"))
    tokens = lines.select("leaf", "line", "lines", F.posexplode("tokens").alias("at", "token"))
    # a leaf's counts are kept apart by place and token, so a leaf with very many lines is spread over many keys
    support = tokens.groupBy("leaf", "at", "token").agg(F.sum("lines").alias("have"))
    fixed = (F.col("have") >= min_docs) & (F.col("token") != F.lit(int(np.array(_VARIABLE).view(np.int64))))
    marked = tokens.join(support, ["leaf", "at", "token"]).withColumn("fixed", fixed)
    part = F.when(F.col("fixed"), F.xxhash64("at", "token")).otherwise(F.xxhash64("at"))
    shapes = marked.groupBy("leaf", "line").agg(
        F.bit_xor(part).alias("shape"), F.avg(F.col("fixed").cast("double")).alias("share"), F.first("lines").alias("lines")
    )
    shapes = table(shapes.where(F.col("share") >= fixed_share).select("leaf", "line", "shape", "lines"))
    held = spread_join(found.select("key", "id", "leaf", "line"), shapes, ["leaf", "line"], "lines", "key")
    counted = held.groupBy("leaf", "shape", F.coalesce(F.col("id").cast("string"), F.lit("")).alias("of")).agg(F.count("*").alias("rows"))
    often = counted.groupBy("leaf", "shape").agg(F.count("*").alias("docs"), F.sum("rows").alias("rows"))
    often = table(often.where(F.col("docs") >= min_docs).select("leaf", "shape", "rows"))
    return spread_join(held, often, ["leaf", "shape"], "rows", "key").groupBy("key").agg(F.collect_set("line").alias("drop"))


def drop_recurring_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, min_docs: int = MIN_DOCS,
    fixed_share: float = FIXED_SHARE, copy_share: float = COPY_SHARE,
) -> DataFrame:
    """All columns of ``docs`` with the text rewritten, and ``__lines``, ``__dropped``: its lines and those dropped."""
    drop = recurring_lines(docs, id_col, text_col, depth, min_docs, fixed_share)
    drop = drop.select(F.col("key").alias("__key"), F.col("drop").alias("__drop"))
    joined = docs.join(drop, _row_key(id_col, text_col) == F.col("__key"), "left").drop("__key")
    others = [c for c in docs.columns if c != text_col]
    sent = joined.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(others)), F.col(text_col).alias("text"), F.col("__drop").alias("drop"))
    types = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(others))

    def run(batches):
        for batch in batches:
            texts, wanted = batch.column(len(others)), batch.column(len(others) + 1)
            new: list = []
            counts: list[int] = []
            dropped: list[int] = []
            for first, end, buf, offsets in text_pieces(texts):
                lines = Lines(buf, offsets, depth)
                at = np.searchsorted(lines.text, np.arange(end - first + 1))
                for i in range(end - first):
                    text = texts[first + i].as_py()
                    gone = wanted[first + i].as_py()
                    number = text.count("\n") + 1 if text else 0
                    mine = slice(at[i], at[i + 1])
                    hit = np.isin(lines.line[mine], np.array(gone, np.int64)) if gone else np.zeros(0, bool)
                    if not hit.any() or lines.n[mine][hit].sum() > copy_share * lines.n[mine].sum():
                        new.append(text), counts.append(number), dropped.append(0)
                        continue
                    out = set(lines.number[mine][hit].tolist())
                    new.append("\n".join(x for k, x in enumerate(text.split("\n")) if k not in out))
                    counts.append(number), dropped.append(len(out))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(others))), pa.array(new, pa.string()), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())],
                names=[*(f"c{i}" for i in range(len(others))), "text", "lines", "dropped"],
            )

    out = sent.mapInArrow(lean(run), (types + ", " if types else "") + "text string, lines long, dropped long")
    return out.toDF(*others, text_col, "__lines", "__dropped").select(*docs.columns, "__lines", "__dropped")
