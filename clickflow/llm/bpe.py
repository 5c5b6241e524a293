"""Byte-pair encoding with a priority queue of merge ranks over a doubly linked list of symbols, and decoding.

A text is cut at the special tokens, then into words by the vocabulary's pattern; each word's bytes become a linked list
of symbols. The queue holds (rank, place) of every adjacent pair; the lowest comes first, an entry whose symbols have
changed since is skipped, and a merge pushes the pairs it forms with its two neighbours: O(n log n) for a word of n
bytes. Words repeat, so a task keeps a bounded table of the words it has met. Decoding joins the vocabulary's byte
strings of the ids and reads the bytes as UTF-8 (invalid ones become U+FFFD).

The vocabulary is the only state, about 4 MB; its path is a parameter, read by each Python worker once. Texts are
independent rows: no shuffle. A null text counts as empty; an empty text has no ids and decodes to the empty text.
"""

from __future__ import annotations

import functools
import hashlib
import json
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.llm.common import lean, small_batches

#: The published pattern of this family of byte-level vocabularies (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words that a task remembers; the table is emptied when it is full.
REMEMBERED = 700_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file: itself, or 256 and up in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Ids, byte strings and merge ranks of a vocabulary file, with the table of words met so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        model = spec["model"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        ids = {t: i for t, i in model["vocab"].items() if t not in self.special}
        self.strings = {i: bytes(letters[c] for c in t) for t, i in ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.of_byte = [ids[letter] for letter, _ in sorted(letters.items(), key=lambda x: x[1])]
        #: rank of a pair (left << 20 | right); the pair and the made symbol of a rank
        self.ranks: dict[int, int] = {}
        self.pairs: list[int] = []
        self.made: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs.append(ids[a] << 20 | ids[b])
            self.made.append(ids[a + b])
            self.ranks.setdefault(self.pairs[rank], rank)
        self.words = regex.compile(PATTERN)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.met: dict[str, tuple[int, ...]] = {}
        self.decimal = {i: str(i) for i in self.strings}

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Ids of one word. Queue entries are rank << 32 | place: a rank names its pair, so a stale entry shows."""
        ids = list(map(self.of_byte.__getitem__, word))
        n = len(ids)
        find, pairs, symbol = self.ranks.get, self.pairs, self.made
        queue = [r << 32 | i for i in range(n - 1) if (r := find(ids[i] << 20 | ids[i + 1])) is not None]
        if not queue:
            return tuple(ids)
        heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ids.append(-1)  # what stands after the last symbol
        while queue:
            entry = heappop(queue)
            i = entry & 0xFFFFFFFF
            rank = entry >> 32
            j = after[i]
            if j > n or ids[i] < 0 or ids[j] < 0 or ids[i] << 20 | ids[j] != pairs[rank]:
                continue  # stale: one of the two has been merged since
            ids[i] = made = symbol[rank]
            ids[j] = -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := find(made << 20 | ids[k])) is not None:
                    heappush(queue, r << 32 | i)
            h = before[i]
            if h >= 0 and (r := find(ids[h] << 20 | made)) is not None:
                heappush(queue, r << 32 | h)
        return tuple([x for x in ids if x >= 0])

    def _ids(self, words: list[str]) -> list[int]:
        met = self.met
        for w in set(words).difference(met):
            if len(w) <= 64:
                met[w] = self.merge(w.encode())
        if len(met) > REMEMBERED:
            self.met = {}
        try:
            return list(chain.from_iterable(map(met.__getitem__, words)))
        except KeyError:  # very long words are not remembered
            return list(chain.from_iterable([met[w] if w in met else self.merge(w.encode()) for w in words]))

    def encode(self, text: str) -> list[int]:
        if self.specials is None or not any(s in text for s in self.special):
            return self._ids(self.words.findall(text))
        out: list[int] = []
        for part in self.specials.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += self._ids(self.words.findall(part))
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, read once by each Python worker."""
    return Vocabulary(path)


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row, in their order: ``(id_col, n_tokens, ids array<int>, exact)`` and the columns of ``keep``.

    exact: decoding gives the text again.
    """
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    kept = [f"k{i}" for i in range(len(keep))]
    types = "".join(f", {k} {docs.schema[c].dataType.simpleString()}" for k, c in zip(kept, keep))

    def run(batches):
        v = vocabulary(path)
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                texts = [t or "" for t in part.column(1).to_pylist()]
                ids = [v.encode(t) for t in texts]
                exact = [v.decode(x) == t for x, t in zip(ids, texts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(exact, pa.bool_()), *part.columns[2:]],
                    names=["id", "n_tokens", "ids", "exact", *kept],
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *(F.col(c).alias(k) for k, c in zip(kept, keep)))
    return rows.mapInArrow(lean(run), f"id {id_type}, n_tokens long, ids array<int>, exact boolean{types}").toDF(id_col, "n_tokens", "ids", "exact", *keep)


def decoded(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row for each row: ``(id_col, text)`` of the ids; null ids count as none."""
    small_batches(tokens.sparkSession)
    id_type = tokens.schema[id_col].dataType.simpleString()

    def run(batches):
        v = vocabulary(path)
        for batch in batches:
            texts = [v.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    rows = tokens.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, f"id {id_type}, text string").withColumnRenamed("id", id_col)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row: ``(id_col, n_tokens, ids_sha256, decoded_sha256)`` of the ids and of the decoded text.

    The same encoder and decoder as ``encoded``; only the digests leave the Python worker.
    """
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        v = vocabulary(path)
        for batch in batches:
            n, of_ids, of_text = [], [], []
            for x in batch.column(1):
                ids = v.encode(x.as_py() or "")
                n.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(v.decimal.__getitem__, ids)).encode()).hexdigest())
                of_text.append(hashlib.sha256(v.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
