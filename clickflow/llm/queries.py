"""One registered query for each operator, over its whole table, and DuckDB SQL where SQL can state it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.llm import bpe, embed_dedup, hard_negatives, line_dedup, merkle, minhash, mixing, periodic_runs, pii, quality, suffix_dedup, topk, url_filter
from clickflow.llm.common import read

#: Whole-number weights of the mix; all other sources share the last one.
TARGET, OTHER_TARGET = {"src0": 4, "src1": 3, "src2": 3, "src3": 2, "src4": 2, "src5": 2}, 14
PSEUDONYM_KEY = "a key of the deployment"


def op1_template_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.drop_recurring_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "text", F.col("__lines").alias("n_lines"), F.col("__dropped").alias("n_dropped"))


def op2_redirect_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"))


def op3_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").where(~quality.held_out(F.col("doc_id")))
    rows = quality.scores(docs, quality.fit(docs, labels))
    return rows.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"), bpe.default_vocabulary())


def op6_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(read(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), shingle_words=4)


def op8_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "source"), TARGET, OTHER_TARGET)
    return rows.select("doc_id", "source", F.col("__group").alias("mix_group"), F.col("__block").alias("block"), F.col("__slot").alias("slot"), F.col("__place").alias("place"))


def op9_merkle_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprint_edits(read(spark, sf_dir, "documents"))


def op10_multi_index_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_embeddings(read(spark, sf_dir, "embeddings"))


def op11_rns_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf_dir, "embeddings").withColumn("label", moved)
    found = hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def repeated_tail(text: Column, h: Column) -> Column:
    """Where ``h`` ends in 0, the words with those from a on replaced by the first p of them, over and over."""
    words, g = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), F.floor(h / 10)

    def made(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i >= a, a + (i - a) % p).otherwise(i).cast("int")
        return F.when(n > 0, F.concat_ws(" ", F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, place(i)))))

    return F.coalesce(F.when(h % 10 == 0, F.transform(F.array(words), made)[0]), text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return periodic_runs.periodic_runs(docs.withColumn("text", repeated_tail(F.col("text"), F.crc32(F.col("doc_id").cast("string")))))


QUERIES = {f.__name__: f for f in (
    op1_template_line_dedup, op2_redirect_url_filter, op3_subword_quality, op4_suffix_dedup, op5_bpe_round_trip,
    op6_feistel_pseudonyms, op7_minhash_near_dedup, op8_pfair_mixing, op9_merkle_fingerprint, op10_multi_index_near_dedup,
    op11_rns_hard_negatives, op12_threshold_top_k, op13_periodic_runs,
)}

_A_TO_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_OP1 = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
raw AS (SELECT r, doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS k, unnest(string_split(text, chr(10))) AS line FROM docs),
toks AS (SELECT r, doc_id, k, list_filter(string_split_regex(line, '[ \t\v\f\r]+'), lambda x: x <> '') AS t FROM raw),
lines AS (SELECT r, doc_id, k, list_transform(t, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN NULL ELSE x END) AS t, len(t) AS n FROM toks WHERE len(t) > 0),
tree AS (SELECT *, struct_pack(n := n, a := t[1], b := t[2], c := t[3]) AS leaf FROM lines),
hot AS (SELECT leaf FROM tree GROUP BY leaf HAVING count(DISTINCT r) >= 5),
cand AS (SELECT DISTINCT r, doc_id, leaf, t FROM tree SEMI JOIN hot ON tree.leaf IS NOT DISTINCT FROM hot.leaf),
kinds AS (SELECT leaf, t, count(*) AS c FROM cand GROUP BY leaf, t),
each AS (SELECT leaf, t, c, generate_subscripts(t, 1) AS p, unnest(t) AS tok FROM kinds),
have AS (SELECT leaf, p, tok, sum(c) AS c FROM each GROUP BY leaf, p, tok),
marked AS (SELECT e.leaf, e.t, e.p, e.tok, (h.c >= 5 AND e.tok IS NOT NULL) AS fixed FROM each e JOIN have h
    ON e.leaf IS NOT DISTINCT FROM h.leaf AND e.p = h.p AND e.tok IS NOT DISTINCT FROM h.tok),
shapes AS (SELECT leaf, t, list(CASE WHEN fixed THEN tok END ORDER BY p) AS shape FROM marked GROUP BY leaf, t HAVING avg(fixed::INT) >= 0.6),
held AS (SELECT cand.r, cand.doc_id, cand.leaf, cand.t, shape FROM cand JOIN shapes ON cand.leaf IS NOT DISTINCT FROM shapes.leaf AND cand.t IS NOT DISTINCT FROM shapes.t),
often AS (SELECT leaf, shape FROM held GROUP BY leaf, shape HAVING count(DISTINCT coalesce(doc_id::VARCHAR, '')) >= 5),
gone AS (SELECT r, leaf, t FROM held SEMI JOIN often ON held.leaf IS NOT DISTINCT FROM often.leaf AND held.shape IS NOT DISTINCT FROM often.shape),
hit AS (SELECT tree.r, tree.k, tree.n, gone.r IS NOT NULL AS hit FROM tree LEFT JOIN gone
    ON tree.r = gone.r AND tree.leaf IS NOT DISTINCT FROM gone.leaf AND tree.t IS NOT DISTINCT FROM gone.t),
drops AS (SELECT r FROM hit GROUP BY r HAVING bool_or(hit) AND sum(CASE WHEN hit THEN n ELSE 0 END) <= 0.5 * sum(n)),
kept AS (SELECT raw.r, string_agg(line, chr(10) ORDER BY raw.k) AS text, count(*) AS c FROM raw SEMI JOIN drops ON raw.r = drops.r
    ANTI JOIN (SELECT r, k FROM hit WHERE hit) h ON raw.r = h.r AND raw.k = h.k GROUP BY raw.r),
counts AS (SELECT r, count(*) AS n FROM raw GROUP BY r)
SELECT doc_id, CASE WHEN kept.r IS NULL THEN docs.text ELSE kept.text END AS text,
    CASE WHEN docs.text IS NULL OR docs.text = '' THEN 0 ELSE counts.n END AS n_lines,
    CASE WHEN kept.r IS NULL THEN 0 ELSE counts.n - kept.c END AS n_dropped
FROM docs LEFT JOIN kept ON docs.r = kept.r LEFT JOIN counts ON docs.r = counts.r
"""

_CANONICAL = r"""regexp_replace(regexp_replace(
    regexp_replace(translate(regexp_extract({rest}, '^([^/?]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^(?:www|m)\.', '')
    || '', '^$', '') || regexp_replace(regexp_replace(regexp_replace(regexp_extract({rest}, '^[^/?]*(.*)$', 1),
    '([?&])(?:utm_[a-z]+|ref)=[^&]*', '\1', 'g'), '[?&]+$', ''), '(?:\.html|/)$', ''), '^$', '')"""


def _canonical(url: str) -> str:
    return _CANONICAL.format(rest=f"regexp_replace(regexp_replace({url}, '^[^:]*://', ''), '#.*$', '')")


_OP2 = rf"""
WITH RECURSIVE parts AS (
    SELECT row_number() OVER () AS r, page_id, url, html,
        CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT *, translate(regexp_extract(rest, '^([^/?#]*)', 1), {_A_TO_Z}) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
rules(verdict, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fit AS (SELECT r, arg_max(verdict, length(h || p)) AS verdict, arg_max(h || p, length(h || p)) AS rule FROM split, rules
    WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r),
named AS (SELECT url, unnest([{_canonical("url")},
    regexp_extract(regexp_extract(html, '(?i)<link\b[^>]*\brel\s*=\s*["\x27]?canonical\b[^>]*>'), '(?i)\bhref\s*=\s*["\x27]?([^"\x27\s>]+)', 1),
    regexp_extract(regexp_extract(html, '(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["\x27]?refresh\b[^>]*>'), '(?i)\burl\s*=\s*["\x27]?([^"\x27\s>]+)', 1)]) AS target
    FROM split WHERE contains(url, '://')),
links AS (SELECT DISTINCT 'u:' || url AS a, 'c:' || CASE WHEN contains(target, '://') THEN {_canonical("target")} ELSE target END AS b FROM named WHERE target <> ''),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, root) AS (SELECT a, a FROM edges UNION SELECT e.b, reach.root FROM reach JOIN edges e ON e.a = reach.node),
blocked AS (SELECT DISTINCT 'u:' || url AS root FROM split JOIN fit USING (r) WHERE verdict = 'block'),
bad AS (SELECT DISTINCT node FROM reach SEMI JOIN blocked ON reach.root = blocked.root)
SELECT page_id, host, path, rule, coalesce(fit.verdict, CASE WHEN bad.node IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
    fit.rule IS NULL AND bad.node IS NOT NULL AS by_alias
FROM split LEFT JOIN fit USING (r) LEFT JOIN bad ON bad.node = 'u:' || split.url
"""

_OP7 = rf"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(text, {_A_TO_Z}), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT r, doc_id, CASE WHEN coalesce(len(w), 0) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM docs),
named AS (SELECT r, doc_id, len(s) AS n, CASE WHEN len(s) > 0 THEN md5(array_to_string(list_sort(s), chr(10))) END AS k, s FROM sets),
kinds AS (SELECT k, any_value(n) AS n, any_value(s) AS s, min(doc_id) AS rep FROM named WHERE k IS NOT NULL GROUP BY k),
flat AS (SELECT rep, n, unnest(s) AS x FROM kinds),
linked AS (SELECT a.rep AS a, b.rep AS b FROM flat a JOIN flat b ON a.x = b.x AND a.rep < b.rep
    GROUP BY a.rep, b.rep, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM linked UNION SELECT b, a FROM linked),
reach(node, root) AS (SELECT rep, rep FROM kinds UNION SELECT e.b, reach.root FROM reach JOIN edges e ON e.a = reach.node),
comps AS (SELECT node, min(root) AS c FROM reach GROUP BY node)
SELECT doc_id, n AS n_shingles, coalesce(c, doc_id) AS component_id, doc_id = coalesce(c, doc_id) AS kept
FROM (SELECT doc_id, named.n, rep FROM named LEFT JOIN kinds USING (k)) x LEFT JOIN comps ON comps.node = x.rep
"""

_GROUP = "CASE " + " ".join(f"WHEN source = '{s}' THEN '{s}'" for s in TARGET) + " ELSE 'other' END"
_WEIGHTS = ", ".join(f"('{s}', {w})" for s, w in (TARGET | {"other": OTHER_TARGET}).items())
_TOTAL = sum(TARGET.values()) + OTHER_TARGET

#: Earliest deadline first over the sorted sources: `sent` holds how many blocks each has sent.
_OP8 = f"""
WITH RECURSIVE weights(g, w) AS (VALUES {_WEIGHTS}),
lists AS (SELECT list(g ORDER BY g) AS gs, list(w ORDER BY g) AS ws FROM weights),
steps(t, sent, pick) AS (
    SELECT 0, list_transform(ws, lambda x: 0), 0 FROM lists
    UNION ALL
    SELECT t + 1, list_transform(range(1, len(ws) + 1), lambda i: sent[i] + (i = p)::INT), p FROM (
        SELECT t, sent, ws, list_position(due, list_min(due)) AS p FROM (
            SELECT t, sent, ws, list_transform(range(1, len(ws) + 1), lambda i:
                CASE WHEN sent[i] < ws[i] AND (sent[i] * {_TOTAL}) // ws[i] <= t THEN ((sent[i] + 1) * {_TOTAL} + ws[i] - 1) // ws[i] ELSE 1000000 END) AS due
            FROM steps, lists WHERE t < {_TOTAL}))),
slots AS (SELECT gs[pick] AS g, sent[pick] - 1 AS k, t - 1 AS s FROM steps, lists WHERE t > 0),
ranked AS (SELECT doc_id, source, {_GROUP} AS g, row_number() OVER (PARTITION BY {_GROUP} ORDER BY md5(coalesce(doc_id::VARCHAR, ''))) - 1 AS r FROM documents)
SELECT doc_id, source, ranked.g AS mix_group, r // {mixing.BLOCK} AS block, ((r // {mixing.BLOCK}) // w) * {_TOTAL} + s AS slot, (r % {mixing.BLOCK})::INT AS place
FROM ranked JOIN weights ON weights.g = ranked.g JOIN slots ON slots.g = ranked.g AND slots.k = (r // {mixing.BLOCK}) % w
"""


def _tree(text: str) -> str:
    words = "array_to_string(list_transform(string_split(p, ' '), lambda w, i: CASE WHEN i = 1 THEN '' WHEN substr(md5(w), 1, 1) IN ('0', '1') THEN chr(10) ELSE ' ' END || w), '')"
    return f"""list_transform(string_split({text}, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)), lambda p:
        list_transform(string_split({words}, chr(10)), lambda x: md5(x))))"""


def _print(tree: str) -> str:
    root = f"md5(array_to_string(list_transform({tree}, lambda s: md5(array_to_string(list_transform(s, lambda p: md5(array_to_string(p, ','))), ','))), ','))"
    return f"{root} || ':' || array_to_string(list_transform({tree}, lambda s: array_to_string(list_transform(s, lambda p: array_to_string(p, ',')), '/')), ';')"


def _alike(a: str, ta: str, b: str, tb: str) -> str:
    la, lb = f"flatten(flatten({ta}))", f"flatten(flatten({tb}))"
    return f"CASE WHEN {a} = {b} THEN 1.0::DOUBLE ELSE len(list_intersect({la}, {lb}))::DOUBLE / len(list_distinct(list_concat({la}, {lb}))) END"


_OP9 = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
tail AS (SELECT *, coalesce(lead(text) OVER w, first_value(text) OVER w) AS following FROM docs WINDOW w AS (ORDER BY doc_id DESC)),
edits AS (SELECT *, substr(text, 1, n - n // 3) || substr(following, 1, n // 3) AS edited FROM tail),
trees AS (SELECT doc_id, n, edited, {_tree("text")} AS t, {_tree("edited")} AS te, {_tree("following")} AS tn FROM edits),
prints AS (SELECT doc_id, n, edited, t, te, tn, {_print("t")} AS f, {_print("te")} AS fe, {_print("tn")} AS fn FROM trees)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, f AS fingerprint, fe AS edited_fingerprint,
    {_alike("f", "t", "fe", "te")} AS near_edited, {_alike("f", "t", "fn", "tn")} AS near_next,
    len(list_filter(list_distinct(flatten(flatten(te))), lambda x: NOT list_contains(flatten(flatten(t)), x)))::BIGINT AS n_changed FROM prints
"""

_OP10 = """
WITH RECURSIVE vecs AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
sound AS (SELECT vec_id, label, v, sqrt(list_inner_product(v, v)) AS norm FROM vecs WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(v) > 0
    AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.98),
reach(node, root) AS (SELECT vec_id, vec_id FROM vecs UNION SELECT l.b, reach.root FROM reach JOIN links l ON l.a = reach.node),
comps AS (SELECT node, min(root) AS c FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(c, vec_id) AS component_id, vec_id = coalesce(c, vec_id) AS kept
FROM vecs LEFT JOIN counts ON a = vec_id LEFT JOIN comps ON node = vec_id
"""

_INTEGERS = """SELECT vec_id, {label} AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""

_OP11 = f"""
WITH moved AS (SELECT * REPLACE (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label) FROM embeddings),
vecs AS (SELECT row_number() OVER () AS r, * FROM ({_INTEGERS.format(label="label").replace("FROM embeddings", "FROM moved")} AND label IS NOT NULL)),
scored AS (SELECT a.r AS ar, b.r AS br, a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
    FROM vecs a JOIN vecs b ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.v) = len(b.v)),
positives AS (SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, b, br) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, (row_number() OVER (PARTITION BY p.ar, p.br ORDER BY n.score DESC, n.b, n.br))::INT AS rank,
    n.b AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.ar = p.ar AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""

_OP12 = f"""
WITH vecs AS (SELECT row_number() OVER () AS r, * FROM ({_INTEGERS.format(label="NULL")}))
SELECT a.vec_id AS query_id, (row_number() OVER (PARTITION BY a.r ORDER BY list_inner_product(a.v, b.v) DESC, b.vec_id, b.r))::INT AS rank,
    b.vec_id, list_inner_product(a.v, b.v)::BIGINT AS score
FROM vecs a JOIN vecs b ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.v) = len(b.v) QUALIFY rank <= 5
"""

#: CRC-32 bit by bit; 3988292384 is its reversed polynomial.
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
    lambda h, c: list_reduce(list_concat([xor(h, c)], range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

#: Every lag that a run can have, word by word; a stretch found at two lags is a run of the smaller one.
_OP13 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(text, '[ 	-
]+'), lambda x: x <> '') AS w,
    CASE WHEN doc_id IS NOT NULL THEN {_CRC32} END AS h FROM documents),
sized AS (SELECT r, doc_id, coalesce(w, []) AS w, coalesce(len(w), 0) AS n, CASE WHEN h % 10 = 0 THEN h // 10 END AS g FROM docs),
tails AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM sized),
steps AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM tails),
texts AS (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w
    ELSE list_transform(range(n), lambda i: w[(CASE WHEN i >= a THEN a + (i - a) % p ELSE i END) + 1]) END AS w FROM steps),
words AS (SELECT r, n, generate_subscripts(w, 1) - 1 AS i, unnest(w) AS word FROM texts),
grams AS (SELECT r, n, i, word, lag(word) OVER t AS w1, lag(word, 2) OVER t AS w2, lag(word, 3) OVER t AS w3, lag(word, 4) OVER t AS w4 FROM words WINDOW t AS (PARTITION BY r ORDER BY i)),
-- the fifth and later matches of every lag; five are the least that a run has
met AS (SELECT y.r, y.i - x.i AS lag, y.i FROM grams x JOIN grams y ON x.r = y.r AND x.word = y.word AND x.w1 = y.w1 AND x.w2 = y.w2 AND x.w3 = y.w3 AND x.w4 = y.w4
    AND x.i < y.i AND 4 * (y.i - x.i) <= y.n),
islands AS (SELECT r, lag, i, i - row_number() OVER (PARTITION BY r, lag ORDER BY i) AS island FROM met),
stretches AS (SELECT r, lag, min(i) - 4 - lag AS s, max(i) - min(i) + 5 + lag AS len FROM islands GROUP BY r, lag, island),
runs AS (SELECT r, s, len, min(lag) AS p FROM stretches WHERE len >= greatest(6, 4 * lag) GROUP BY r, s, len),
listed AS (SELECT r, count(*) AS n, string_agg(s || ',' || len || ',' || p || chr(10), '' ORDER BY s, p) AS txt FROM runs GROUP BY r),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY len::HUGEINT * 1000000000000 // p DESC, s, p) = 1),
gone AS (SELECT DISTINCT r, unnest(range(s + p, s + len)) AS i FROM runs),
kept AS (SELECT words.r, string_agg(word, ' ' ORDER BY words.i) AS txt FROM words ANTI JOIN gone ON words.r = gone.r AND words.i = gone.i GROUP BY words.r)
SELECT doc_id, coalesce(listed.n, 0) AS n_runs, s AS start, len AS length, p AS period, 1000 * len // p AS exponent_milli,
    sha256(coalesce(listed.txt, '')) AS runs_sha256, sha256(coalesce(kept.txt, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed ON texts.r = listed.r LEFT JOIN best ON texts.r = best.r LEFT JOIN kept ON texts.r = kept.r
"""

ORACLE_SQL = {
    "op1_template_line_dedup": _OP1,
    "op2_redirect_url_filter": _OP2,
    "op7_minhash_near_dedup": _OP7,
    "op8_pfair_mixing": _OP8,
    "op9_merkle_fingerprint": _OP9,
    "op10_multi_index_near_dedup": _OP10,
    "op11_rns_hard_negatives": _OP11,
    "op12_threshold_top_k": _OP12,
    "op13_periodic_runs": _OP13,
}
