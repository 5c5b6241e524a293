"""Helpers shared by the operators: table reading, the shared folder, Arrow text buffers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy pass works on; a longer document is one pass of its own.
CHUNK_BYTES = 1 << 18
#: A key that holds this share of the rows, or more, is dealt over ``PARTS`` partitions by ``spread_join``.
HEAVY_SHARE, PARTS = 1 / 1000, 64


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 500 rows, so that a Python worker holds a few MB of texts at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")


def give_back() -> None:
    """Return the freed memory of this Python worker, which Spark keeps for later tasks, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def lean(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``, giving back at its end what the task has freed."""

    def task(batches):
        yield from run(batches)
        give_back()

    return task


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a private one only on a local master where that is unset (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="llm-shared-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared checkpoint folder (survives lost executors)."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def table(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet under the shared folder: compressed, for wide intermediate results."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread_join(rows: DataFrame, keyed: DataFrame, keys: list[str], weight: str, by: str) -> DataFrame:
    """Inner join of ``rows`` with the written table ``keyed`` (one row for each key) where a few keys may hold most rows.

    ``weight`` is the number of ``rows`` of a key (dropped from the result). Keys with ``HEAVY_SHARE`` of all weight are at
    most ``1 / HEAVY_SHARE``, so their list is broadcast; their rows are dealt over ``PARTS`` partitions by the column ``by``.
    """
    total = keyed.agg(F.sum(weight)).first()[0] or 0
    heavy = keyed.where(F.col(weight) >= total * HEAVY_SHARE).select(*keys, F.lit(True).alias("__heavy"))
    one, parts = F.array(F.lit(0)), F.sequence(F.lit(0), F.lit(PARTS - 1))
    part = F.when(F.col("__heavy"), F.pmod(F.xxhash64(by), F.lit(PARTS)).cast("int")).otherwise(0)
    dealt = rows.join(F.broadcast(heavy), keys, "left").withColumn("__part", part).drop("__heavy")
    is_heavy = F.col(weight) >= total * HEAVY_SHARE
    copies = keyed.withColumn("__part", F.explode(F.when(is_heavy, parts).otherwise(one))).drop(weight)
    return dealt.join(copies, [*keys, "__part"]).drop("__part")


def text_pieces(column: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts: (first row, end row, UTF-8 bytes, offsets of the texts in them). Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + chunk_bytes, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, raw[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows that are equal in the first ``keys`` columns (integers without nulls), across batches."""
    held: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        if held is not None:
            now = pa.concat_tables([held, now]).combine_chunks()
        if not now.num_rows:
            continue
        change = np.zeros(now.num_rows - 1, bool)
        for i in range(keys):
            values = now.column(i).to_numpy()
            change |= values[1:] != values[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield now.slice(a, b - a)
        held = now.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield held
