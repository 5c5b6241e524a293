"""Edge cases of the training-data operators, and the classifier's features against a plain version."""

import hashlib
import re

import numpy as np
import pytest

pytest.importorskip("clickflow.llm")

import pyarrow as pa  # noqa: E402

from clickflow.llm import bpe, hashing, line_dedup, mixing, quality, suffix_dedup  # noqa: E402
from clickflow.llm.common import spread_join  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, leaf string, key long, line string, score double, __slot int"


def docs_of(spark, rows):
    """Documents whose extra columns have names that the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", "a" if i and i % 2 else None, "x", 7, "y", 0.25, 3) for i, t in rows], DOCS)


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in rng.integers(0, 300, n))


SCRIPTS = ["日本語 のテキスト です", "ab", "é", "", None, "naïve café 🎉🎉🎉 x", "привет мир", "one\ttwo\nthree three", "a b c d", "plain words only here", "日 本 語"]


def plain_features(text):
    """Words, pairs and character runs as plain tuples, one for each occurrence."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = [("w", w) for w in words]
    out += [("p", *((1,) if a == b else (a, b))) for a, b in zip(words, words[1:])]
    flat = re.sub(r"[\x20\x09-\x0D]", " ", text)
    for n in (3, 4, 5):
        out += [("c", flat[i : i + n]) for i in range(len(flat) - n + 1) if " " not in flat[i + 1 : i + n - 1]]
    return out


def test_quality_features_are_those_of_a_plain_version():
    made = list(quality._document_features(pa.array(SCRIPTS)))
    assert len(made) == len(SCRIPTS)
    names: dict = {}
    for text, (buckets, shares) in zip(SCRIPTS, made):
        wanted = plain_features(text or "")
        assert round(float(shares.sum()), 4) == (1.0 if wanted else 0.0)
        # a text of one feature alone names the bucket of each feature; here: equal features, equal buckets, right counts
        counts = np.rint(shares * len(wanted)).astype(int)
        assert counts.sum() == len(wanted)
        assert sorted(counts.tolist()) == sorted({f: wanted.count(f) for f in wanted}.values())
        for f in set(wanted):
            names.setdefault(f, []).append(set(buckets.tolist()))
    for places in names.values():
        assert set.intersection(*places)


def test_quality_scores_are_the_mean_of_the_features(spark):
    rng = np.random.default_rng(3)
    table, bias = rng.normal(size=quality.BUCKETS).astype(np.float32), 0.3
    got = {r.doc_id: r.score for r in quality.scores(docs_of(spark, enumerate(SCRIPTS)), (table, bias)).collect()}
    for i, (buckets, shares) in enumerate(quality._document_features(pa.array(SCRIPTS))):
        logit = float((table[buckets].astype(float) * shares).sum()) + bias
        assert abs(got[i] - 1 / (1 + np.exp(-logit))) < 1e-5


def test_quality_of_no_rows_and_repeated_rows(spark):
    rows = [(i, prose(i % 2, 30)) for i in range(6)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, quality int")
    docs = docs_of(spark, rows)
    model, twice = quality.fit(docs, labels), quality.fit(docs.unionAll(docs), labels)
    assert model[1] == twice[1] and np.array_equal(model[0], twice[0])
    got = quality.scores(docs.unionAll(docs), model).collect()
    assert len(got) == 12 and len({(r.doc_id, r[1]) for r in got}) == 6
    nothing = quality.fit(docs.limit(0), labels)
    assert nothing[1] == 0 and not nothing[0].any() and quality.scores(docs.limit(0), model).count() == 0


def test_quality_sample_ends_at_its_bytes(spark):
    rows = [(i, prose(i, 50)) for i in range(20)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    docs = docs_of(spark, rows)
    whole, by_rows = quality.fit(docs, labels), quality.fit(docs, labels, sample=10)
    order = [r[0] for r in labels.selectExpr("doc_id", "xxhash64(doc_id) AS h").orderBy("h").collect()][:10]
    size = sum(len(dict(rows)[i]) for i in order)
    by_bytes = quality.fit(docs, labels, sample_bytes=size)
    assert by_rows[1] == by_bytes[1] and np.array_equal(by_rows[0], by_bytes[0]) and not np.array_equal(whole[0], by_rows[0])


def test_spread_join_is_an_inner_join(spark):
    rows = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(9000)] + [(None, 1)], "k long, v long")
    keyed = rows.where("k is not null").groupBy("k").count().where("k % 5 = 0").selectExpr("k", "k * 2 as twice", "count as n")
    keyed = spark.createDataFrame(keyed.collect(), keyed.schema)
    want = rows.join(keyed.drop("n"), "k")
    got = spread_join(rows, keyed, ["k"], "n", "v")
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and got.count() == want.count() > 6000
    assert spread_join(rows, keyed.limit(0), ["k"], "n", "v").count() == 0


def test_line_dedup_of_null_and_shared_ids_and_long_texts(spark):
    shared = "the same footer stands here in every document of them all"
    rows = [(i, prose(i, 30) + "\n" + shared) for i in range(5)]
    # null ids and rows of one id are one document each when documents are counted
    few = [(None if i < 4 else 9, prose(20 + i, 30) + "\nanother line that only two ids hold at all") for i in range(8)]
    long = [(100, "\n".join(prose(1000 + i, 12) for i in range(20000)) + "\n" + shared)]
    docs = docs_of(spark, [*rows, *few, *long, (None, None), (None, ""), (None, None)])
    got = line_dedup.drop_recurring_lines(docs).collect()
    assert len(got) == 17
    assert {c: r[c] for r in got for c in ("leaf", "key", "line")} == {"leaf": "x", "key": 7, "line": "y"}
    by_text = {r.text: r["__dropped"] for r in got}
    for _, t in rows + long:
        assert by_text[t[: -len(shared) - 1]] == 1
    for _, t in few:
        assert by_text[t] == 0
    assert by_text[None] == by_text[""] == 0


def test_suffix_dedup_of_null_and_repeated_ids(spark):
    text, other = prose(1, 80), prose(2, 90)
    rows = [(None, text), (None, text + " end"), (3, other), (3, other), (4, prose(5, 60)), (None, None)]
    got = sorted((r.doc_id is None, r.n_bytes, r.n_removed) for r in suffix_dedup.remove_repeats(docs_of(spark, rows)).collect())
    n, m = len(text), len(other)
    assert got == sorted([(True, n, n), (True, n + 4, n), (False, m, m), (False, m, m), (False, len(prose(5, 60)), 0), (True, 0, 0)])


def test_bpe_of_no_rows_and_repeated_rows(spark):
    path = bpe.default_vocabulary()
    docs = docs_of(spark, [(1, "some text"), (1, "some text"), (None, "some text"), (2, None)])
    got = [tuple(r) for r in bpe.digests(docs, path).collect()]
    assert len(got) == 4 and len({g[1:] for g in got[:3]}) == 1
    assert (2, 0, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"").hexdigest()) == got[3][:4]
    assert bpe.digests(docs.limit(0), path).count() == 0


def test_mixing_keeps_columns_of_clashing_names(spark):
    docs = docs_of(spark, [(i, f"text {i}") for i in range(50)])
    out = mixing.in_mixed_order(docs, {"a": 1})
    assert out.columns == docs.columns and {r["__slot"] for r in out.collect()} == {3}
    assert out.count() == 50


def test_hashes_of_equal_words_are_equal():
    buf = np.frombuffer("ab é ab".encode(), np.uint8)
    starts, ends, at = hashing.spans(buf, np.array([0, len(buf)]))
    h = hashing.run_hashes(buf, starts, ends)
    assert h[0] == h[2] != h[1] and at.tolist() == [0, 3]


def test_mixing_puts_its_columns_in_the_place_of_equal_names(spark):
    docs = docs_of(spark, [(i, f"text {i}") for i in range(200)])
    out = mixing.mix(docs, {"a": 1})
    assert sorted(out.columns) == sorted({*docs.columns, *mixing.ADDED})
    plain = mixing.mix(docs.drop("__slot"), {"a": 1}).select(*out.columns)
    assert out.exceptAll(plain).count() == 0 and out.select("__slot").distinct().count() > 1


def test_tasks_pass_over_little_text_and_give_their_memory_back(monkeypatch):
    from clickflow.llm import common

    texts = pa.array(["word " * 2000] * 120)  # 1.2 MB
    pieces = list(common.text_pieces(texts))
    assert max(len(buf) for _, _, buf, _ in pieces) <= 1 << 18
    assert [p[0] for p in pieces] == [0, *(p[1] for p in pieces[:-1])] and pieces[-1][1] == 120
    ended = []
    monkeypatch.setattr(common, "give_back", lambda: ended.append(True))
    task = common.lean(lambda batches: (b + 1 for b in batches))(iter([1, 2]))
    assert next(task) == 2 and not ended
    assert list(task) == [3] and ended == [True]
