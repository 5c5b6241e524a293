"""Operators of the training-data pipeline against brute force, round trips and hand-made edge cases."""

import hashlib
import itertools
import os
import re
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from clickflow.llm import bpe, components, embed_dedup, line_dedup, merkle, minhash, mixing, pii, quality, queries, suffix_dedup, url_filter  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, component_id long"


def docs_of(spark, texts):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", f"src{i % 3}" if i % 4 else None, len(t or ""), "x", 7) for i, t in enumerate(texts)], DOCS)


WORDS = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS, n))


@pytest.fixture(scope="module")
def texts():
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    passage = prose(2, 60)
    out = [base, base, " ".join(near), prose(3, 80) + " " + passage, prose(4, 90) + " " + passage + " " + prose(5, 40)]
    out += [None, "", " ", "ab", "one two", "one two", "é" * 150 + passage, "Say " * 300, prose(6, 4000)]
    out += [prose(10 + i, 30) + "\nLicensed under terms " + str(i) + " of use.\n" + prose(30 + i, 30) for i in range(6)]
    return out


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(20, 40)] + [(5, 100 + i) for i in range(50)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {i: 20 for i in range(20, 41)} | {5: 5} | {100 + i: 5 for i in range(50)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_suffix_dedup_is_brute_force(spark, texts):
    blobs = [(t or "").encode() for t in texts]
    seen = {}
    for i, b in enumerate(blobs):
        for j in range(len(b) - 199):
            seen.setdefault(b[j : j + 200], []).append((i, j))
    gone = [np.zeros(len(b), bool) for b in blobs]
    for places in seen.values():
        if len(places) > 1:
            for i, j in places:
                gone[i][j : j + 200] = True
    want = {}
    for i, (b, g) in enumerate(zip(blobs, gone)):
        kept = np.frombuffer(b, np.uint8)[~g].tobytes()
        spans = int((np.diff(np.r_[0, g.astype(int)]) == 1).sum())
        want[i] = (len(b), int(g.sum()), spans, hashlib.sha256(kept).hexdigest())
    assert sum(w[1] for w in want.values()) > 1000
    for segments in (4096, 1):  # sorted buckets, then counted ones
        rows = suffix_dedup.remove_repeats(docs_of(spark, texts), bucket_segments=segments).collect()
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want
    assert suffix_dedup.remove_repeats(docs_of(spark, ["x"]).limit(0)).count() == 0


def test_bpe_equals_the_tokenizers_library(spark, texts):
    from tokenizers import Tokenizer

    path = bpe.default_vocabulary()
    theirs = Tokenizer.from_file(path)
    theirs.no_truncation()
    theirs.no_padding()
    some = [*texts, "a<|endoftext|>b  c\n\n d", "  \t x", "日本語 🎉🎉 ½ Ⅷ", "can't WON'T it's", "x" * 3000, "é\u0085 y"]
    rows = {r.doc_id: r for r in bpe.encoded(docs_of(spark, some), path).collect()}
    digests = {r.doc_id: r for r in bpe.digests(docs_of(spark, some), path).collect()}
    back = {r.doc_id: r.text for r in bpe.decoded(bpe.encoded(docs_of(spark, some), path), path).collect()}
    for i, t in enumerate(some):
        ids = theirs.encode(t or "", add_special_tokens=False).ids
        text = theirs.decode(ids, skip_special_tokens=False)
        assert rows[i].ids == ids and rows[i].exact and back[i] == text
        assert digests[i].n_tokens == len(ids) and digests[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def brute_groups(texts, k, percent=80):
    def shingles(t):
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({i: i + 32 for i in range(65, 91)}))
        return {tuple(words[i : i + k]) for i in range(max(len(words) - k + 1, 1))} if words else set()

    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    for i, j in itertools.combinations(range(len(texts)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            a, b = sorted((root[i], root[j]))
            root = [a if r == b else r for r in root]
    return {i: (len(s), root[i], root[i] == i) for i, s in enumerate(sets)}


def test_minhash_is_brute_force(spark, texts):
    many = [*texts, *(" ".join(w if (i * 7 + s) % 90 else f"edit{s}" for i, w in enumerate(prose(50, 100).split())) for s in range(20))]
    for k in (4, 5):
        rows = minhash.near_duplicates(docs_of(spark, many), shingle_words=k).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == brute_groups(many, k)
    kept = minhash.one_of_each_group(docs_of(spark, many))
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, _, k) in brute_groups(many, 5).items() if k}
    assert kept.columns == docs_of(spark, many).columns
    assert minhash.near_duplicates(docs_of(spark, ["x"]).limit(0)).count() == 0


def test_minhash_null_and_repeated_ids(spark):
    t = prose(1, 50)
    df = spark.createDataFrame([(None, t), (None, t), (3, t), (3, t), (2, t)], "doc_id long, text string")
    rows = sorted(((r.doc_id is None, r.doc_id or 0, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()), key=repr)
    assert rows == [(False, 2, 2, True), (False, 3, 2, False), (False, 3, 2, False), (True, 0, None, True), (True, 0, None, True)]
    assert minhash.one_of_each_group(df).count() == 3


def test_minhash_versions_of_one_id(spark):
    """Rows of one id are one document: the links of all its texts count, in any order of rows."""
    a, b, c = prose(61, 100), prose(62, 140), prose(63, 100)
    near = lambda t, i: " ".join("changed" if j == i else w for j, w in enumerate(t.split()))
    rows = [(1, a), (1, b), (2, near(a, 50)), (3, near(b, 70)), (4, c), (5, near(c, 3)), (5, near(a, 90)), (6, None), (6, near(c, 60))]
    for data in (rows, rows[::-1]):
        got = minhash.near_duplicates(spark.createDataFrame(data, "doc_id long, text string")).collect()
        assert {(r.doc_id, r.component_id) for r in got if r.n_shingles} == {(i, 1) for i in (1, 2, 3, 4, 5, 6)}
        kept = minhash.one_of_each_group(spark.createDataFrame(data, "doc_id long, text string")).collect()
        assert [r.text for r in kept if r.doc_id == 1] == [min((a, b), key=lambda t: hashlib.md5(t.encode()).hexdigest())]


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 100, 5000):
        s = minhash.sketch(np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)))
        assert (s < np.iinfo(np.uint64).max).all()
    a = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    x, y = minhash.sketch(np.unique(a[:850])), minhash.sketch(np.unique(a[50:]))
    assert abs((x == y).mean() - 800 / 900) < 0.06


def test_line_dedup_drops_templates_and_keeps_copies(spark, texts):
    rows = {r.doc_id: r for r in line_dedup.drop_recurring_lines(docs_of(spark, texts)).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        licensed = t is not None and "Licensed" in t
        assert rows[i]["__dropped"] == int(licensed)
        assert rows[i].text == ("\n".join(x for x in t.split("\n") if "Licensed" not in x) if licensed else t)
    copies = [prose(1, 40) + "\n" + prose(2, 40)] * 8
    assert {r["__dropped"] for r in line_dedup.drop_recurring_lines(docs_of(spark, copies)).collect()} == {0}
    assert line_dedup.drop_recurring_lines(docs_of(spark, ["x"]).limit(0)).count() == 0


def test_quality_held_out_accuracy(spark):
    from clickflow.llm.common import read

    docs, labels = read(spark, "/root/testdata/sf0.01", "documents"), read(spark, "/root/testdata/sf0.01", "labels")
    got = {r.doc_id: r for r in queries.op3_subword_quality(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [(r.quality, got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) > 0.9


def test_quality_without_labels_and_empty_texts(spark, texts):
    docs = docs_of(spark, texts)
    none = quality.fit(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality.scores(docs, none).collect()} == {0.5}
    one = quality.fit(docs, spark.createDataFrame([(0, 1), (1, 1), (2, None)], "doc_id long, quality int"))
    assert min(r.score for r in quality.scores(docs, one).collect()) > 0.99


def test_pseudonyms_are_valid_linked_and_reversible(spark):
    key = "k"
    text = "card 4944339490429605, again 4944-3394-9042-9605, bad 4944339490429606; +1 (456) 555-2186; 61.131.143.218 and 999.1.1.1; 2024-02-29, 2023-02-30; 123-45-6789; a.b@mail1.example.com"
    a, b, c, d = pii.pseudonymise(spark.createDataFrame([(1, text), (2, text), (3, None), (4, "plain words")], "doc_id long, text string"), key).collect()
    assert a.text == b.text and a.text != text and c.text is None and d.text == "plain words"
    assert (a.n_card, a.n_phone, a.n_ip, a.n_date, a.n_ssn, a.n_email) == (2, 1, 1, 1, 1, 1)
    for kept in ("4944339490429606", "999.1.1.1", "2023-02-30"):
        assert kept in a.text
    card = re.search(r"card (\d{16}), again ([\d-]{19}),", a.text)
    assert card[1] == card[2].replace("-", "")
    digits = [int(x) for x in card[1][::-1]]
    assert sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(digits)) % 10 == 0

    def undo(value, hi, lo, kind):
        h, low = divmod(value, lo)
        for i in reversed(range(pii.ROUNDS)):
            f = lambda half: int(hashlib.sha256(f"{key}:{kind}:{i}:{half}".encode()).hexdigest()[:15], 16)
            h, low = ((h - f(low)) % hi, low) if i % 2 == 0 else (h, (low - f(h)) % lo)
        return h * lo + low

    assert undo(int(card[1][1:15]), 10**7, 10**7, "card") == 94433949042960
    octets = re.search(r"; (\d+)\.(\d+)\.(\d+)\.(\d+) and", a.text)
    number = sum(int(x) << s for x, s in zip(octets.groups(), (24, 16, 8, 0)))
    assert undo(number, 65536, 65536, "ip") == (61 << 24) + (131 << 16) + (143 << 8) + 218


def test_pseudonyms_beside_other_digits(spark):
    joined, grouped, amex, phone = "4111111111111111", "4111 1111 1111 1111", "3782-822463-10005", "415-555-0100"
    cases = [
        (joined, (0, 1)), ("call 555-123-4567 90210", (1, 0)), (f"1 {joined}", (0, 1)), (f"{joined} 123", (0, 1)), (f"12 {grouped}", (0, 1)),
        (f"12-{grouped.replace(' ', '-')}-9", (0, 1)), (f"{phone} {grouped}", (1, 1)), (f"1234 {grouped}", (0, 1)), (f"{amex} {joined}", (0, 2)),
        ("4111 1111 1111 1112 5", (0, 0)), ("41111111 11111111", (0, 1)), ("+1 (017) 555-7713", (1, 0)), ("+1 (117) 555-7713", (1, 0)), ("017-555-7713", (0, 0)),
    ]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)] + [(99, phone)], "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.pseudonymise(docs, "k").collect()}
    for i, (t, counts) in enumerate(cases):
        assert (rows[i].n_phone, rows[i].n_card) == counts, t
        assert re.sub("[0-9]", "0", rows[i].text) == re.sub("[0-9]", "0", t)
        assert (rows[i].text == t) == (counts == (0, 0)), t
    # the value found beside other digits is the value found alone
    card = rows[0].text
    assert rows[2].text == f"1 {card}" and rows[3].text == f"{card} 123" and rows[8].text.endswith(card)
    for i, before, after in ((4, "12 ", ""), (5, "12-", "-9"), (6, rows[99].text + " ", ""), (7, "1234 ", ""), (10, "", "")):
        assert re.sub("[ -]", "", rows[i].text) == re.sub("[ -]", "", before) + card + re.sub("[ -]", "", after)
    assert all(re.fullmatch(r"\+1 \([01]\d\d\) \d{3}-\d{4}", rows[i].text) for i in (11, 12)) and rows[11].text != rows[12].text


def test_pseudonyms_of_very_long_texts(spark):
    """Patterns neither recurse with the text nor go over it again and again; the address beside the noise is found."""
    end = " write to a.b@mail1.example.com, call (415) 555-0100"
    noise = ["x@" + "a." * 100_000 + "com", "x@" + "a." * 500_000, "a." * 500_000, "@" * 1_000_000, "a@" * 500_000, "7" * 1_000_000, "7 " * 500_000, "1." * 500_000, "1-" * 500_000, "1.1.1.1" * 100_000]
    df = spark.createDataFrame([(i, t + end) for i, t in enumerate(noise)], "doc_id long, text string")
    for r in pii.pseudonymise(df, "k").collect():
        assert (r.n_email, r.n_phone) == (1, 1), r.doc_id
        assert r.text.startswith(noise[r.doc_id]) or r.n_card, r.doc_id


def test_pseudonyms_of_no_rows_and_clashing_names(spark):
    assert pii.pseudonymise(docs_of(spark, ["x"]).limit(0), "k").count() == 0
    rows = spark.createDataFrame([(1, "61.131.143.218", "h", "p", 9)] * 2, "doc_id long, text string, hits string, pattern string, n_ip int")
    got = pii.pseudonymise(rows, "k").collect()
    assert got[0] == got[1] and got[0].n_ip == 1 and got[0].text != "61.131.143.218"


def brute_pseudonyms(text, key):
    """All kinds, written anew: one scan from left to right, values permuted by a Feistel network of integers."""
    import datetime

    def feistel(v, hi, lo, kind):
        h, low = divmod(v, lo)
        for i in range(pii.ROUNDS):
            f = lambda half: int(hashlib.sha256(f"{key}:{kind}:{i}:{half}".encode()).hexdigest()[:15], 16)
            h, low = ((h + f(low)) % hi, low) if i % 2 == 0 else (h, (low + f(h)) % lo)
        return h * lo + low

    def luhn(d):
        return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(int(c) for c in reversed(d))) % 10 == 0

    def refill(shape, digits):
        left = iter(digits)
        return "".join(next(left) if "0" <= c <= "9" else c for c in shape)

    def date(m):
        for mark, pattern in (("-", "%Y-%m-%d"), (".", "%d.%m.%Y"), ("/", "%m/%d/%Y")):
            if mark in m:
                try:
                    at = (datetime.datetime.strptime(m, pattern).date() - datetime.date(1800, 1, 1)).days
                except ValueError:
                    return None
                if not 0 <= at < 189 * 773:
                    return None
                day = datetime.date(1800, 1, 1) + datetime.timedelta(feistel(at, 189, 773, "date"))
                return day.strftime(pattern)

    def ip(m):
        octets = [int(x) for x in m.split(".")]
        if max(octets) > 255:
            return None
        v = feistel(int.from_bytes(bytes(octets), "big"), 65536, 65536, "ip")
        return ".".join(map(str, v.to_bytes(4, "big")))

    def ssn(m):
        a, g, s = map(int, m.split("-"))
        if not (0 < a < 900 and a != 666 and g and s):
            return None
        v = feistel((a - 1 if a < 666 else a - 2) * 99 * 9999 + (g - 1) * 9999 + s - 1, 898, 99 * 9999, "ssn")
        a, rest = divmod(v, 99 * 9999)
        return f"{a + 1 if a < 665 else a + 2:03d}-{rest // 9999 + 1:02d}-{rest % 9999 + 1:04d}"

    def phone(m):
        d = re.sub("[^0-9]", "", m)
        ten = int(d[-10:])
        new = feistel(ten - 2 * 10**9, 80_000, 100_000, "phone") + 2 * 10**9 if ten >= 2 * 10**9 else feistel(ten, 20_000, 100_000, "phone0")
        return refill(m, d[:-10] + f"{new:010d}")

    def card(m):
        d = re.sub("[^0-9]", "", m)
        inner = d[1:-1]
        left = len(inner) // 2
        body = d[0] + f"{feistel(int(inner), 10**left, 10 ** (len(inner) - left), 'card'):0{len(inner)}d}"
        return refill(m, body + next(c for c in "0123456789" if luhn(body + c)))

    cards = []
    for shape in pii.CARD_SHAPES:
        cards += [m[1] for m in re.finditer(rf"(?<![0-9])(?=({shape})(?![0-9]))", text) if luhn(re.sub("[^0-9]", "", m[1]))]
    cards = list(dict.fromkeys(cards))
    kinds = [
        ("email", rf"(?<![A-Za-z0-9._%+-])(?:{pii.EMAIL})", lambda m: "u" + hashlib.sha256(f"{key}:email:{m.lower()}".encode()).hexdigest()[:12] + "@anon.invalid"),
        ("date", rf"(?<![0-9.])(?:{pii.DATE})(?![0-9]|\.[0-9])", date), ("ip", rf"(?<![0-9.])(?:{pii.IP})(?![0-9]|\.[0-9])", ip),
        ("ssn", rf"(?<![0-9+-])(?:{pii.SSN})(?![0-9-])", ssn), ("phone", rf"(?<![0-9])(?:{pii.PHONE})(?![0-9])", phone),
    ]
    if cards:
        kinds.append(("card", rf"(?<![0-9])(?:{'|'.join(map(re.escape, cards))})(?![0-9])", card))
    found = [(name, re.compile(p), make) for name, p, make in kinds]
    counts, out, at = dict.fromkeys(pii.KINDS, 0), [], 0
    while at < len(text):
        for name, p, make in found:
            if m := p.match(text, at):
                new = make(m[0])
                counts[name] += new is not None
                out.append(m[0] if new is None else new)
                at = m.end()
                break
        else:
            out.append(text[at])
            at += 1
    return "".join(out), *counts.values()


def test_pseudonyms_are_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(200)
    made = ["1800-01-01 2199-12-31 2200-01-01 1799-12-31", "01.02.2003 29.02.2023 02/29/2024 13/01/2020", "0.0.0.0 255.255.255.255 256.1.1.1 1.2.3.4.5", "000-12-3456 666-12-3456 665-99-9999 667-01-0001 899-99-9999 900-01-0001"]
    made += ["a@b.co. x@y.z u@a.b.c.museum, A@B.CO", "4111111111111111 4111-1111-1111-1111 378282246310005 6011000990139424", "(212) 555-0100 +1 212-555-0100 212.555.0100 112-555-0100", None, ""]
    docs = docs.unionByName(spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(made)], docs.schema))
    want = {r.doc_id: brute_pseudonyms(r.text, "k") if r.text is not None else (None, *[0] * 6) for r in docs.collect()}
    assert sum(sum(w[1:]) for w in want.values()) > 30
    for r in pii.pseudonymise(docs, "k").collect():
        assert tuple(r)[1:] == want[r.doc_id], r.doc_id


def test_mixing_deviates_by_less_than_one_block(spark):
    weights = {"a": 7, "b": 3, "c": 2, "other": 5}
    total = sum(weights.values())
    sent = dict.fromkeys(weights, 0)
    for slot, (s, k, at) in enumerate(mixing.period(weights), 1):
        assert at == slot - 1 and k == sent[s]
        sent[s] += 1
        assert all(abs(sent[x] - slot * w / total) < 1 for x, w in weights.items())
    assert sent == weights
    df = spark.createDataFrame([(i, "ab"[i % 2] if i % 5 else None) for i in range(500)] + [(None, "a")], "doc_id long, source string")
    rows = mixing.mix(df, {"a": 2, "b": 1}, block=8).collect()
    assert len(rows) == 501 and len({(r["__slot"], r["__place"]) for r in rows}) == 501
    assert mixing.in_mixed_order(df, {"a": 2, "b": 1}).count() == 501
    assert mixing.mix(df.limit(0), {"a": 2}).count() == 0


def test_url_rules_aliases_and_edge_cases(spark):
    link = '<link rel="canonical" href="http://shop.com/x">'
    rows = [
        (1, "http://A.Example.NET/en/1", ""), (2, "https://x.net/a?b#c", ""), (3, "https://x.net", ""), (4, "http://example.com/de/", None),
        (5, None, None), (6, "nothing", ""), (7, "http://bad.net/spam", link), (8, "http://shop.com/x#top", ""), (9, "http://a.org/fr/z", link),
        (10, "http://notexample.com/de/", ""), (10, "http://notexample.com/de/", ""), (11, "http://net/", ""),
    ]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {
        1: ("a.example.net", "/en/1", "example.net/en/", "allow"), 2: ("x.net", "/a", "net/", "block"), 3: ("x.net", "", None, "allow"),
        4: ("example.com", "/de/", "example.com/de/", "block"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"),
        7: ("bad.net", "/spam", "net/", "block"), 8: ("shop.com", "/x", None, "block"), 9: ("a.org", "/fr/z", "org/fr/", "allow"),
        10: ("notexample.com", "/de/", None, "allow"), 11: ("net", "/", "net/", "block"),
    }


def test_url_targets_are_resolved_and_ruled(spark):
    link, hop = '<link rel="canonical" href="{}">', '<meta http-equiv="refresh" content="0; url={}">'
    base = "http://h.com/a/b/c?q=1#f"
    names = {
        "http://o.com/x": "http://o.com/x", "//o.com/x": "http://o.com/x", "/x?u=http://o.com/": "http://h.com/x?u=http://o.com/", "x": "http://h.com/a/b/x",
        "../x": "http://h.com/a/x", "./x/../../y?z": "http://h.com/a/y?z", "../../../x": "http://h.com/x", "..": "http://h.com/a/", "?z": "http://h.com/a/b/c?z",
        "#z": "http://h.com/a/b/c?q=1", "mailto:a@b.c": None, "/x/./y/..": "http://h.com/x/",
    }
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(t, base) for t in names] + [("x", "http://h.com")], "t string, u string")
    assert [r.r for r in df.select(url_filter.resolved(F.col("t"), F.col("u")).alias("r")).collect()] == [*names.values(), "http://h.com/x"]
    rows = [
        # targets that are no rows: blocked by their own rule, also when two pages meet there
        (1, "http://a.com/1", link.format("http://spam.net/x")), (2, "http://b.com/2", hop.format("//www.spam.net/y")), (3, "http://c.com/3", link.format("http://clean.com/x")),
        # one path on two hosts is two pages
        (4, "http://bad.net/x", link.format("/x")), (5, "http://good.com/p", link.format("/x")), (6, "http://good.com/x", ""), (7, "http://else.com/d/p", hop.format("x")),
        # a relative target leads to the page it names
        (8, "http://example.com/de/1", hop.format("../fr/2")), (9, "http://example.com/fr/2", ""), (10, "http://example.com/fr/d/3", link.format("../2.html")),
        (11, "http://bad.net/m", link.format("mailto:x")), (12, "http://good.com/m", link.format("mailto:x")),
    ]
    got = {r.page_id: (r.verdict, r.by_alias) for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    alias, own, clean = ("block", True), ("block", False), ("allow", False)
    assert got == {1: alias, 2: alias, 3: clean, 4: own, 5: clean, 6: clean, 7: clean, 8: own, 9: alias, 10: alias, 11: own, 12: clean}


def test_merkle_neighbours_edits_and_places(spark, texts):
    rows = {r.doc_id: r for r in merkle.fingerprint_edits(docs_of(spark, texts)).collect()}
    full = [t or "" for t in texts]
    for i, t in enumerate(full):
        following = full[i - 1] if i else full[-1]
        k = len(t) // 3
        edited = t[: len(t) - k] + following[:k]
        assert rows[i].n_chars == len(t) and rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert rows[0].fingerprint == rows[1].fingerprint and rows[1].near_next == 1.0
    assert rows[13].near_edited > 0.4 and rows[13].near_next < 0.05
    old = merkle.RANGE_ROWS, merkle.CUTS
    try:
        merkle.RANGE_ROWS, merkle.CUTS = 3, 2  # several ranges give the same neighbours
        again = {r.doc_id: r for r in merkle.fingerprint_edits(docs_of(spark, texts)).collect()}
    finally:
        merkle.RANGE_ROWS, merkle.CUTS = old
    assert again == rows


def merkle_leaves(paragraph):
    leaves = []
    for i, w in enumerate(paragraph.split(" ")):
        if i == 0 or hashlib.md5(w.encode()).hexdigest()[0] in "01":
            leaves.append([])
        leaves[-1].append(w)
    return [hashlib.md5(" ".join(x).encode()).hexdigest() for x in leaves]


def test_merkle_is_brute_force(spark, texts):
    node = lambda xs: hashlib.md5(",".join(xs).encode()).hexdigest()
    full = [t or "" for t in [*texts, "a\n\n\nb c\n", prose(71, 60) + "\n\n" + prose(72, 60) + "\n" + prose(73, 60)]]

    def tree(t):
        return [[merkle_leaves(p) for p in s.split("\n")] for s in t.split("\n\n")]

    def fingerprint(t):
        root = node([node([node(p) for p in s]) for s in tree(t)])
        return root + ":" + ";".join("/".join(",".join(p) for p in s) for s in tree(t))

    def alike(a, b):
        a, b = ({x for s in tree(t) for p in s for x in p} for t in (a, b))
        return len(a & b) / len(a | b)

    for r in merkle.fingerprint_edits(docs_of(spark, full)).collect():
        t, following = full[r.doc_id], full[r.doc_id - 1]
        k = len(t) // 3
        edited = t[: len(t) - k] + following[:k]
        assert (r.fingerprint, r.edited_fingerprint) == (fingerprint(t), fingerprint(edited))
        assert (r.near_edited, r.near_next) == (pytest.approx(alike(t, edited)), pytest.approx(alike(t, following)))
        assert r.n_changed == len({x for s in tree(edited) for p in s for x in p} - {x for s in tree(t) for p in s for x in p})


def test_merkle_edits_stay_in_their_leaf(spark):
    from pyspark.sql import functions as F

    words = [f"{w}{i}" for i, w in enumerate(prose(80, 400).split())]
    longer = [*words[:5], "inserted", *words[5:]]
    before = prose(81, 50) + "\n" + prose(82, 50) + "\n\n"
    pairs = [(" ".join(words), " ".join(longer)), (before + " ".join(words), before + " ".join(longer)), (" ".join(words), " ".join(words)), ("text 1", "text 2"), (None, "")]
    df = spark.createDataFrame(pairs, "a string, b string").select(*(merkle.fingerprint_of(merkle.tree(F.col(c))).alias(c) for c in "ab"))
    got = df.select(merkle.likeness(F.col("a"), F.col("b")), merkle.differing_leaves(F.col("b"), F.col("a")), merkle.changed_leaves(F.col("b"), F.col("a"))).collect()
    assert all(x > 0.9 for x, _, _ in got[:2])
    assert [tuple(x) for x in got[0][1]] == [(0, 0, got[0][1][0].leaf)] and got[0][1][0].leaf < 6
    assert [tuple(x) for x in got[1][1]] == [(1, 0, got[0][1][0].leaf)]
    assert [len(x[2]) for x in got] == [1, 1, 0, 1, 0] and [x[0] for x in got[2:]] == [1.0, 0.0, 1.0]


def test_merkle_of_one_row_and_none(spark):
    one = merkle.fingerprint_edits(docs_of(spark, ["a b c d e f"])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0 and one[0].n_chars == 11
    assert merkle.fingerprint_edits(docs_of(spark, ["x"]).limit(0)).count() == 0
    plan = merkle.fingerprint_edits(docs_of(spark, ["a"] * 9))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan and "Python" not in plan


def test_embeddings_are_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((60, 8)).astype(np.float32)
    vectors = np.concatenate([base, base[:20] + rng.standard_normal((20, 8)).astype(np.float32) * 0.05, base[:5]])
    rows = [(i, v.tolist(), int(i % 2) if i % 11 else None) for i, v in enumerate(vectors)]
    rows += [(900, None, 1), (901, [], 1), (902, [0.0] * 8, 1), (903, [float("nan")] * 8, 1), (904, [None] * 8, 1), (905, [float("inf")] * 8, 1)]
    rows += [(906, base[1].tolist(), 1), (907, base[1].tolist(), 0)]
    got = {r.vec_id: r for r in embed_dedup.near_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    sound = [(i, np.array(v, np.float64), lab) for i, v, lab in rows if lab is not None and (i < 900 or i > 905)]
    links = {i: set() for i, _, _ in rows}
    for (i, x, a), (j, y, b) in itertools.combinations(sound, 2):
        if a == b and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
            links[i].add(j), links[j].add(i)
    assert sum(map(len, links.values())) > 10
    for i in links:
        reach, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - reach
            reach |= new
            todo += new
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (len(links[i]), min(reach), min(reach) == i)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embed_dedup.near_embeddings(empty).count() == 0


def test_embeddings_of_several_lengths(spark):
    rng = np.random.default_rng(8)
    vectors = []
    for width, n in ((8, 90), (5, 60), (3, 12), (2, 2)):
        base = rng.standard_normal((n, width))
        vectors += [*base, *(base * 2.5), *(base[: n // 2] + rng.standard_normal((n // 2, width)) * 0.05)]
    vectors += [np.array([x]) for x in (1.0, 2.0, 2.0, -3.0, 0.5, -1e-200)] + [base[0] * 1e200, base[0] * 1e-200, np.array([1e-300, 0.0, 0.0, 0.0])]
    # as floats these two were one vector
    vectors += [np.array([1.0, 0, 0, 0, 0, 0, 0]), np.array([1.0, 1e-12, 0, 0, 0, 0, 0])]
    rows = [(i, v.tolist(), int(i % 2)) for i, v in enumerate(vectors)]
    got = {r.vec_id: r for r in embed_dedup.near_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    links = {i: set() for i, _, _ in rows}
    unit = [(v / np.abs(v).max()) / np.linalg.norm(v / np.abs(v).max()) for v in vectors]
    for (i, _, a), (j, _, b) in itertools.combinations(rows, 2):
        if a == b and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98:
            links[i].add(j), links[j].add(i)
    assert {len(vectors[i]) for i in links if links[i]} >= {1, 2, 3, 5, 8}
    found = sum(got[i].n_links for i in links)
    assert all(got[i].n_links <= len(links[i]) for i in links) and found >= 0.95 * sum(map(len, links.values()))
    # up to 64 vectors of a length are all compared
    for i in links:
        if len(vectors[i]) in (1, 2, 3, 4, 7):
            assert got[i].n_links == len(links[i]) and got[i].component_id == min(links[i] | {i})


def test_embeddings_of_repeated_ids_and_any_types(spark):
    a, b, near = [1.0, 0.0], [0.0, 1.0], [1.0, 0.01]
    frame = lambda rows, kinds: embed_dedup.near_embeddings(spark.createDataFrame(rows, kinds))
    got = frame([(1, a, 1), (1, b, 1), (2, near, 1)], "vec_id long, embedding array<float>, label int").collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 0, 1), (1, 1, 1), (2, 1, 1)]
    # an id with two vectors ties what they link with
    got = frame([(5, a, 1), (5, b, 1), (2, near, 1), (7, b, 1)], "vec_id long, embedding array<float>, label int").collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(2, 1, 2), (5, 1, 2), (5, 1, 2), (7, 1, 2)]
    got = frame([(1, a, 0.2), (2, near, 0.7), (3, a, 0.7)], "vec_id long, embedding array<float>, label double").collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(1, 0, 1), (2, 1, 2), (3, 1, 2)]
    got = frame([("x", a, "l"), ("y", near, "l"), ("z", a, "m"), (None, a, "l")], "vec_id string, embedding array<float>, label string").collect()
    assert sorted((r.vec_id or "", r.n_links, r.component_id) for r in got) == [("", 0, None), ("x", 1, "x"), ("y", 1, "x"), ("z", 0, "z")]


@pytest.mark.parametrize("dim", [2, 3, 4, 16])
def test_index_reaches_neighbours_in_few_dimensions(dim):
    rng = np.random.default_rng(dim)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    sample = unit(rng.standard_normal((5000, dim)))
    index = embed_dedup.MultiIndex(sample, 1_000_000, 0.98)
    x = unit(rng.standard_normal((300, dim)))
    turn = rng.standard_normal(x.shape)
    turn = unit(turn - (turn * x).sum(1, keepdims=True) * x)
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * turn
    met = (index.cells(x, index.visits) == index.cells(y, 1)).any(1)
    assert met.mean() >= 0.95 and index.k == 125


def test_multi_sequence_order_is_sorted():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = embed_dedup.MultiIndex(x, 40_000, 0.98)
    a, b = embed_dedup._distances(x[:, :4], index.books[0]), embed_dedup._distances(x[:, 4:], index.books[1])
    grid = (a[:, :, None] + b[:, None, :]).reshape(len(x), -1)
    got = np.take_along_axis(grid, index.cells(x, 12), 1)
    assert np.allclose(got, np.sort(grid, 1)[:, :12])


def test_pipeline_stages(spark):
    import corpus_pipeline as p
    from clickflow.llm.common import read

    docs = read(spark, SF, "documents")
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes, name
        rows = out.toPandas()
        assert len(rows) <= docs.count() and (name != "mixing" or len(rows) == docs.count())
        docs = spark.createDataFrame(rows, docs.schema)
    tokens = p.STAGES[-1][1](spark, docs, SF).collect()
    assert len(tokens) == docs.count() and all(t.exact for t in tokens)
    # of each near-duplicate group that reached the third stage one document is left
    left = [r.text for r in docs.orderBy("doc_id").collect()]
    assert all(k for _, _, k in brute_groups(left, 5).values())


def test_pipeline_runs_on_nulls_and_on_nothing(spark, tmp_path):
    import corpus_pipeline as p

    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    good = [(i, prose(100 + i, 40), "en", "src0", 1) for i in range(6)]
    odd = [(50, None, "en", "src1", None), (51, "", None, None, 0), (None, prose(7, 30), None, "src1", 3), (None, None, None, None, None), (52, good[0][1], "en", "src2", 1)]
    labels = [(i, int(i % 2), 0) for i in range(6)]
    for name, docs in (("some", [*good, *odd]), ("none", [])):
        spark.createDataFrame(docs, kinds).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        rows = p.run(spark, f"{tmp_path}/{name}").collect()
        assert all(r.exact for r in rows) and len(rows) <= len(docs)
        assert name == "none" or {50, 51} <= {r.doc_id for r in rows}


def test_pipeline_tokens_carry_the_mix(spark, tmp_path):
    import corpus_pipeline as p

    sources = [*queries.TARGET, "elsewhere", None]
    docs = [(i, f"text {i}", sources[i * i % 11 % len(sources)]) for i in range(3000)]
    # several files, whose order is not that of the mix
    spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5).write.parquet(f"{tmp_path}/docs")
    tokens = p.as_tokens(spark, spark.read.parquet(f"{tmp_path}/docs"), SF).collect()
    weights = queries.TARGET | {"other": queries.OTHER_TARGET}
    total = sum(weights.values())
    waiting = {g: [] for g in weights}
    for i, _, s in sorted(docs, key=lambda d: hashlib.md5(str(d[0]).encode()).hexdigest()):
        waiting[s if s in queries.TARGET else "other"].append(i)
    # earliest deadline first, slot by slot; a source that has run out leaves its slots empty
    want, sent, slot = [], dict.fromkeys(weights, 0), 0
    while len(want) < len(docs):
        _, g = min((-(-(sent[g] + 1) * total // w), g) for g, w in weights.items() if sent[g] * total // w <= slot)
        block = waiting[g][sent[g] * mixing.BLOCK :][: mixing.BLOCK]
        want += [(i, g, slot, at) for at, i in enumerate(block)]
        sent[g], slot = sent[g] + 1, slot + 1
    assert [(t.doc_id, t.mix_group, t.slot, t.place) for t in tokens] == want
    assert all(t.exact and t.n_tokens == len(t.ids) for t in tokens)
