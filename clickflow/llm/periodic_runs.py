"""Runs of words that repeat with a period, found online by a sparse diagonal recurrence; later copies can be dropped.

Word i continues the diagonal of lag p if it equals word i - p: its match length is one more than word i - 1 had at that
lag. A diagonal that ends with m matches is a stretch of m + p words with period p; it is a run if it is at least ``LEAST``
words and ``TIMES`` periods long, and it is reported as soon as the next word does not continue it.

What keeps the recurrence sparse: only lags that can become runs are active. Lags are taken in classes from 2**k up to
2**(k+1) - 1. A run of the class ends every diagonal with at least 3 * 2**k matches, so a word's earlier occurrence counts
only where the 3 * 2**k words up to it occur there too. The nearest such occurrence is enough: if these words occur at two
lags below 2**(k+1), both are periods of a stretch as long as their sum, so (Fine and Wilf) the smaller one divides the
larger one, and the larger lag's stretch is that of the smaller. So a class has at most one active lag at a word, each run is
found at its smallest period and once, and a text that is one word over and over costs no more than any other.

The 3 * 2**k words up to a word are numbered by doubling: words, pairs, fours and so on, each the pair of two halves, for
the places only that still occur twice. Numbers are exact, no hashes. This is done for a chunk of whole texts at a time with
numpy; the recurrence itself then runs over the (word, lag) hits that are left.

Words are ``[^\\x20\\x09-\\x0D]+``. A null or empty text, or one of blanks only, has no words and no runs: four nulls, and the
hashes of the empty string. A text of any length is one row of one task; memory grows with its words. Rows are
independent, so repeated and null ids give a row each; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import small_batches

#: A run's least length in words and in periods; words that are numbered together (a longer text is a chunk of its own).
LEAST, TIMES, CHUNK_WORDS = 6, 4, 1 << 20

Run = tuple[int, int, int]


def _numbers(pairs: np.ndarray) -> np.ndarray:
    """0, 1, ... for each different value; -1 for those that occur once."""
    codes, _ = pd.factorize(pairs)
    codes = codes.astype(np.int64)
    return np.where(np.bincount(codes)[codes] > 1, codes, -1) if len(codes) else codes


def _paired(ends: np.ndarray, number: np.ndarray, back: int) -> tuple[np.ndarray, np.ndarray]:
    """For the places ``ends`` (sorted), the number of (number ``back`` words before, number here) where it occurs twice."""
    at = np.searchsorted(ends, ends - back)
    both = np.flatnonzero(ends[at] == ends - back)  # ends - back is never above the last place
    if not len(both):
        return ends[:0], number[:0]
    named = _numbers(number[at[both]] * (number.max() + 1) + number[both])
    kept = named >= 0
    return ends[both][kept], named[kept]


def hits(words: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For each class of lags that ``longest`` words can hold (places, lags, matches up to there at least).

    ``words`` are the numbers of the words of several texts one after another, different in different texts.
    """
    number = _numbers(words)
    ends = np.flatnonzero(number >= 0)
    number = number[ends]
    ends, number = _paired(ends, number, 1)
    lag = 1
    while len(ends) and TIMES * lag <= longest:
        # ``number`` names the 2 * lag words up to a place; two of them, lag apart, are 3 * lag words
        at, context = _paired(ends, number, lag)
        order = np.argsort(context, kind="stable")
        same = context[order][1:] == context[order][:-1]
        back = np.diff(at[order])
        hit = np.flatnonzero(same & (back >= lag) & (back < 2 * lag)) + 1
        where = np.argsort(at[order][hit])
        yield at[order][hit][where], back[hit - 1][where], 3 * lag
        ends, number = _paired(ends, number, 2 * lag)
        lag *= 2


def online(places: Iterator[tuple[int, int, int]]) -> Iterator[Run]:
    """Runs (start, length, period) from (place, lag, matches) in the order of places."""
    active: dict[int, tuple[int, int]] = {}  # lag: last place, match length

    def ended(lag: int) -> Iterator[Run]:
        last, matches = active.pop(lag)
        if matches + lag >= max(LEAST, TIMES * lag):
            yield last - matches - lag + 1, matches + lag, lag

    for place, lag, matches in places:
        for other in [x for x, (last, _) in active.items() if last < place - 1]:
            yield from ended(other)
        active[lag] = (place, active[lag][1] + 1 if lag in active else matches)
    for lag in list(active):
        yield from ended(lag)


def found_runs(texts: list[np.ndarray]) -> list[list[Run]]:
    """The runs of each text, given as numbers of its words from 0 on, by start and then period."""
    out: list[list[Run]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts])
    starts = np.cumsum(sizes) - sizes
    if not sizes.sum():
        return out
    bases = np.cumsum([int(t.max()) + 1 if len(t) else 0 for t in texts])
    words = np.concatenate([t + b for t, b in zip(texts, [0, *bases[:-1]])])
    parts = list(hits(words, int(sizes.max())))
    place, lag, matches = (np.concatenate(x) for x in zip(*((p, g, np.full(len(p), m)) for p, g, m in parts))) if parts else (np.zeros(0, int),) * 3
    order = np.lexsort((lag, place))
    place, lag, matches = place[order], lag[order], matches[order]
    text = np.searchsorted(starts, place, "right") - 1
    cuts = np.flatnonzero(np.diff(text)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(place)]):
        if a < b:
            t = text[a]
            out[t] = sorted(online(zip((place[a:b] - starts[t]).tolist(), lag[a:b].tolist(), matches[a:b].tolist())), key=lambda r: (r[0], r[2]))
    return out


def longest_in_periods(runs: list[Run]) -> Run | None:
    """The run of most periods (exactly), then of smallest start, then of smallest period."""
    best: Run | None = None
    for run in runs:  # in order of start and period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def kept_words(count: int, runs: list[Run]) -> np.ndarray:
    """True for the words that no run contains after its first period."""
    steps = np.zeros(count + 1, np.int64)
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:count]) == 0


def _numbered(text: str | None) -> tuple[list[bytes], np.ndarray]:
    """The words of a text, and for each of them the first place of an equal one."""
    words = (text or "").encode().split()  # bytes split at the six blanks of ASCII
    first: dict[bytes, int] = {}
    return words, np.array([first.setdefault(w, i) for i, w in enumerate(words)], np.int64)


def _rows(ids: list, held: list[tuple[list[bytes], np.ndarray]], schema: pa.Schema) -> pa.RecordBatch:
    out = []
    for doc, (words, numbers), runs in zip(ids, held, found_runs([numbers for _, numbers in held])):
        best = longest_in_periods(runs)
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        kept = b" ".join(words[i] for i in numbers[kept_words(len(words), runs)].tolist())
        four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        out.append((doc, len(runs), *four, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """``(id_col, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256)``, one row for each row.

    The run named is the one of most periods. ``runs_sha256`` is of the lines ``start,length,period`` of every run,
    ``collapsed_sha256`` of the words that no run contains after its first period, joined by blanks.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    longs = ["n_runs", "start", "length", "period", "exponent_milli"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([("id", batch.schema.field(0).type), *((c, pa.int64()) for c in longs), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])
            ids, held, size = [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc)
                held.append(_numbered(text.as_py()))
                size += len(held[-1][0])
                if size >= chunk_words:
                    yield _rows(ids, held, schema)
                    ids, held, size = [], [], 0
            if ids:
                yield _rows(ids, held, schema)

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"id {kind}, {', '.join(f'{c} long' for c in longs)}, runs_sha256 string, collapsed_sha256 string")
    return found.withColumnRenamed("id", id_col)
