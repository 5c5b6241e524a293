"""Exact top-k, hard negatives and periodic runs against brute force, and their edge cases."""

import hashlib
import math
import os
import re
import sys
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from clickflow.llm import hard_negatives, periodic_runs, queries, topk  # noqa: E402

# ``row``, ``id``, ``dim`` and the like are columns of the operators' own
VECTORS = "vec_id long, embedding array<float>, label int, row string, id string, dim string, asks string, score string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, lab, "r", "i", "d", "q", "s") for i, v, lab in rows], VECTORS)


def whole(v):
    return [math.floor(256 * float(np.float32(x))) for x in v]


def takes_part(row):
    i, v, _ = row
    return i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)


def inner(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute_top(rows, k, step):
    rows = [(i, whole(v)) for i, v, lab in filter(takes_part, rows)]
    out = []
    for a, (i, v) in enumerate(rows):
        if i % step == 0:
            near = sorted((-inner(v, w), j) for b, (j, w) in enumerate(rows) if a != b and len(v) == len(w))
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(near[:k])]
    return sorted(out)


def brute_negatives(rows, step, positives=5, negatives=3):
    rows = [(i, whole(v), lab) for i, v, lab in filter(takes_part, rows) if lab is not None]
    out = []
    for a, (i, v, lab) in enumerate(rows):
        if i % step:
            continue
        scored = sorted((-inner(v, w), j, other) for b, (j, w, other) in enumerate(rows) if a != b and len(v) == len(w))
        for s, j, _ in [x for x in scored if x[2] == lab][:positives]:
            inside = [x for x in scored if x[2] != lab and 50 * -s <= 100 * -x[0] <= 95 * -s]
            out += [(i, j, rank + 1, n, -s, -t) for rank, (t, n, _) in enumerate(inside[:negatives])]
    return sorted(out)


def mixed_rows(seed, n, dim=12):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, dim))
    rows = []
    for i in range(n):
        v = centres[i % 4] + 0.5 * rng.standard_normal(dim)
        rows.append((i, (v / np.linalg.norm(v)).tolist(), int(rng.integers(4))))
    rows += [(5, rows[5][1], 1), (10, rows[5][1], 2), (10, rows[10][1], rows[10][2])]  # repeated ids and rows
    rows += [(n + i, rows[3][1], i % 2) for i in range(30)]  # ties
    rows += [(1000, [0.0] * dim, 1), (1005, [], 1), (1010, [], 1), (1011, [], 2), (1015, None, 1), (1020, [float("nan")] * dim, 1), (1025, [None] * dim, 1)]
    rows += [(1030, [float("inf")] * dim, 1), (None, rows[0][1], 1), (1035, rows[0][1], None), (1040, [0.5, -0.25], 1), (1045, [0.25, -0.5], 1), (1046, [0.3, -0.1], 2)]
    return rows


@pytest.mark.parametrize("block, stripe, queries_each", [(4096, 4, 2048), (16, 2, 7), (16, 1, 7)])
def test_top_k_is_brute_force(spark, monkeypatch, block, stripe, queries_each):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "STRIPE", stripe)
    monkeypatch.setattr(topk, "QUERIES", queries_each)
    rows = mixed_rows(1, 200)
    for k in (1, 5, 400):
        got = topk.top_k(vectors_of(spark, rows), F.col("vec_id") % 5 == 0, k)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted(map(tuple, got.collect())) == brute_top(rows, k, 5)


def test_top_k_of_no_rows_and_no_queries(spark):
    assert topk.top_k(vectors_of(spark, []), F.col("vec_id") % 5 == 0).count() == 0
    assert topk.top_k(vectors_of(spark, [(1, [1.0], 1)]), F.col("vec_id") % 5 == 0).count() == 0
    assert topk.top_k(vectors_of(spark, [(5, [1.0], 1)]), F.col("vec_id") % 5 == 0).count() == 0


def test_walk_stops_before_the_end_of_the_lists():
    """With one heavy dimension the bound ends the walk early, and rows are scored only as they come up."""
    rng = np.random.default_rng(3)
    values = np.floor(1000 * rng.random((4096, 3)))
    values[:, 1:] = np.floor(values[:, 1:] / 100)
    ids = rng.permutation(4096)

    class Counted(np.ndarray):
        scored = 0

        def __matmul__(self, other):
            Counted.scored += len(self)
            return np.asarray(self) @ np.asarray(other)

    lists = topk.SortedLists(ids, ids, values)
    want = sorted((-inner(v, [9, -1, 1]), i) for i, v in zip(ids.tolist(), values.tolist()))[:5]
    lists.values = lists.values.view(Counted)
    at, scores = lists.walk(np.array([9.0, -1.0, 1.0]), 5, None, None)
    assert [(-s, int(lists.ids[a])) for a, s in zip(at, scores)] == want
    assert 0 < Counted.scored < 2000


def test_large_components_stay_exact(spark):
    """Beyond 2**53 doubles are not exact; whole numbers and residues are. Beyond 64 bits an error says so."""
    rng = np.random.default_rng(4)
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    rows = [(i, [float(x) for x in rng.integers(-(2**20), 2**20, 70)], int(i % 3)) for i in range(40)]
    rows += [(100 + i, [x + 1 / 256 for x in rows[0][1]], i % 3) for i in range(5)]
    exact = [(i, [int(256 * x) for x in v], lab) for i, v, lab in rows]
    anchors = [x for x in exact if x[0] % 5 == 0]
    assert max(abs(inner(a[1], b[1])) for a in anchors for b in exact) > 2**53
    want = []
    for i, v, _ in anchors:
        near = sorted((-inner(v, w), j) for j, w, _ in exact if j != i)[:5]
        want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(near)]
    assert sorted(map(tuple, topk.top_k(frame(rows), F.col("vec_id") % 5 == 0).collect())) == sorted(want)
    a = np.array([x[1] for x in anchors])
    b = np.array([x[1] for x in exact])
    mods = hard_negatives.moduli(2.0**62)
    got = hard_negatives.products(hard_negatives.residues(a, mods), hard_negatives.residues(b, mods), mods)
    assert got.tolist() == [[inner(x[1], y[1]) for y in exact] for x in anchors]
    for search in (lambda d: topk.top_k(d, F.col("vec_id") % 5 == 0), lambda d: hard_negatives.mine(d, F.col("vec_id") % 5 == 0)):
        with pytest.raises(Exception, match="64 bits"):
            search(frame([(0, [1e200], 1), (1, [1e200], 1)])).collect()


def test_residue_products_are_signed_and_exact():
    rng = np.random.default_rng(5)
    for size, dim in ((1, 1), (255, 64), (300, 65), (40_000, 200), (10**8, 3)):
        a, b = rng.integers(-size, size + 1, (17, dim)), rng.integers(-size, size + 1, (23, dim))
        a[0], b[0], b[1] = size, size, -size
        mods = hard_negatives.moduli(float(size) * size * dim)
        got = hard_negatives.products(hard_negatives.residues(a, mods), hard_negatives.residues(b, mods), mods)
        assert (got == a @ b.T).all()
    assert all(hard_negatives.CHUNK * ((p - 1) // 2) ** 2 < 2**24 for p in hard_negatives.primes())
    assert hard_negatives.primes()[0] == 1021


def test_window_is_whole_numbers():
    p = np.array([0, 1, 2, 3, 99, 100, 101, 199, 12345, 2**62], np.int64)
    least, most = hard_negatives.window(p, 50, 95)
    for x, lo, hi in zip(p.tolist(), least.tolist(), most.tolist()):
        assert (lo, hi) == (-(-50 * x // 100), 95 * x // 100)


@pytest.mark.parametrize("tile, step", [(8192, 256), (20, 3)])
def test_hard_negatives_are_brute_force(spark, monkeypatch, tile, step):
    monkeypatch.setattr(hard_negatives, "TILE", tile)
    rows = mixed_rows(2, 200)
    got = hard_negatives.mine(vectors_of(spark, rows), F.col("vec_id") % 5 == 0, step=step)
    want = brute_negatives(rows, 5)
    assert len(want) > 300
    assert sorted(map(tuple, got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())) == want


def test_hard_negatives_of_few_rows_and_text_labels(spark):
    assert hard_negatives.mine(vectors_of(spark, []), F.col("vec_id") % 5 == 0).count() == 0
    assert hard_negatives.mine(vectors_of(spark, [(0, [1.0], 1), (1, [1.0], 2)]), F.col("vec_id") % 5 == 0).count() == 0
    rows = [(0, [1.0, 0.0], "a"), (1, [1.0, 0.0], "a"), (2, [0.75, 0.0], "b"), (3, [0.5, 0.0], "c"), (4, [0.25, 0.0], "b")]
    got = hard_negatives.mine(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string"), F.col("vec_id") == 0)
    assert sorted(map(tuple, got.collect())) == [(0, 1, 1, 2, 65536, 49152), (0, 1, 2, 3, 65536, 32768)]


WORD = r"[^\x20\x09-\x0D]+"


def brute_runs(words):
    """Every stretch with its smallest period, by trying all lags."""
    n, found = len(words), {}
    for p in range(1, n // 4 + 1):
        i = p
        while i < n:
            j = i
            while j < n and words[j] == words[j - p]:
                j += 1
            if j - i + p >= max(6, 4 * p):
                found.setdefault((i - p, j - i + p), p)  # smaller lags come first
            i = max(j, i + 1)
    return sorted((s, length, p) for (s, length), p in found.items())


def brute_row(doc, text):
    words = re.findall(WORD, text or "")
    runs = brute_runs(words)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    listed = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc, len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest(listed), digest(kept))


def run_texts():
    rng = np.random.default_rng(6)
    out = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "a b a b a b a", "a b a b a b a b", "a b c a b c a b c a b", "a b c " * 4, "x " + "a a b b " * 5 + "a a c"]
    out += ["a " * 3000, "a b " * 1500 + "a a " * 700, "a b a b a b a b a b a b", "a\x1cb " * 7, "é ß " * 6, "a\x0bb\x0ca b\ra\nb a b a b"]
    for letters in (1, 2, 3, 5):
        for n in (7, 30, 200, 900):
            out += [" ".join(rng.choice(list("abcde")[:letters], n)) for _ in range(4)]
    for _ in range(40):  # runs beside and inside runs, of long and short periods
        parts = []
        for _ in range(int(rng.integers(1, 6))):
            block = list(rng.choice(list("abcdef"), int(rng.integers(1, 40))))
            parts += (block * 9)[: int(len(block) * rng.uniform(1, 9))]
            parts += list(rng.choice(list("abcdef"), int(rng.integers(0, 6))))
        out.append(" ".join(parts))
    fib = ["a", "a b"]
    while len(fib[-1].split()) < 1500:
        fib.append(fib[-1] + " " + fib[-2])
    return [*out, fib[-1], " ".join("a" if bin(i).count("1") % 2 else "b" for i in range(1024))]


@pytest.mark.parametrize("chunk", [1 << 20, 500])
def test_runs_are_brute_force(spark, chunk):
    texts = run_texts()
    # names of the operator's own columns, and repeated and null ids
    rows = [(i // 2 if i > 3 else None, t, "x", 7) for i, t in enumerate(texts)]
    got = periodic_runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string, id string, n_runs int"), chunk_words=chunk)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [brute_row(d, t) for d, t, _, _ in rows]
    assert sum(w[1] for w in want) > 200
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_runs_of_no_rows_and_text_ids(spark):
    assert periodic_runs.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    got = periodic_runs.periodic_runs(spark.createDataFrame([("x", "to be " * 3)], "name string, body string"), "name", "body").collect()
    assert [tuple(r) for r in got] == [brute_row("x", "to be " * 3)]


def test_a_long_repetitive_text_is_no_square():
    words = np.zeros(1_000_000, np.int64)
    assert periodic_runs.found_runs([words, np.arange(1_000_000) % 7]) == [[(0, 1_000_000, 1)], [(0, 1_000_000, 7)]]
    assert sum(len(p) for p, _, _ in periodic_runs.hits(words, len(words))) < len(words)


def test_repeated_tail(spark):
    words = " ".join(f"w{i}" for i in range(23))
    rows = [(h, t) for h in (0, 10, 70, 231, 45670) for t in (words, "a", "", None, " a\tb ")]
    got = spark.createDataFrame(rows, "h long, text string").select("h", "text", queries.repeated_tail(F.col("text"), F.col("h")).alias("t")).collect()
    for h, text, t in got:
        w = re.findall(WORD, text or "")
        if h % 10 or not w:
            assert t == text
            continue
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        assert re.findall(WORD, t) == [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
