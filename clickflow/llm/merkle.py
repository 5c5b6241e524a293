"""Merkle fingerprints over sections, paragraphs and content-defined leaves; DataFrame functions only.

A section ends at a blank line and a paragraph at a line feed. A paragraph's words (split at single spaces) are cut into
leaves before each word whose md5 begins with 0 or 1, every eighth on average, so words put in or taken out change the leaf
they stand in and no other. A leaf's hash is the md5 of its words, a node's hash the md5 of its children's hashes. The
fingerprint is ``root:leaves``: leaf hashes joined by ``,`` in a paragraph, ``/`` in a section and ``;`` between sections. All
hashes are whole, so equal roots mean equal texts unless md5 collides, and inner nodes follow from the leaves they hold.

The likeness of two fingerprints is the Jaccard similarity of their sets of leaves. ``changed_leaves`` and
``differing_leaves`` find what differs by going down from the root into those sections and paragraphs only that the other
fingerprint does not hold. A text of one paragraph without such words is one leaf.

Null counts as the empty text, whose tree has one empty leaf. Texts of any length are hashed whole, in proportion to their
length. Rows of one id are ordered by their text's md5; null ids come last. In a table of one row the row follows itself; an
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a range of ids that one sorted run holds, and the most ranges; cuts between ranges that are searched at once.
RANGE_ROWS, RANGES, CUTS = 2000, 10_000, 100
#: First digits of the md5 of a word that begins a leaf.
STARTS = ("0", "1")


def _leaves(words: Column) -> Column:
    # a paragraph holds no line feed, so one may mark the cuts
    starts = lambda w: F.substring(F.md5(w), 1, 1).isin(*STARTS)
    parted = F.transform(words, lambda w, i: F.when(i == 0, w).when(starts(w), F.concat(F.lit("\n"), w)).otherwise(F.concat(F.lit(" "), w)))
    return F.transform(F.split(F.concat_ws("", parted), "\n", -1), lambda x: F.md5(x))


def tree(text: Column) -> Column:
    """Sections of paragraphs of leaf hashes."""
    sections = F.split(F.coalesce(text, F.lit("")), "\n\n", -1)
    # words are split once, outside the function that cuts them to leaves
    words = F.transform(sections, lambda s: F.transform(F.split(s, "\n", -1), lambda p: F.split(p, " ", -1)))
    return F.transform(words, lambda s: F.transform(s, _leaves))


def root_of(tree: Column) -> Column:
    node = lambda hashes: F.md5(F.concat_ws(",", hashes))
    return node(F.transform(tree, lambda s: node(F.transform(s, node))))


def fingerprint_of(tree: Column) -> Column:
    body = F.transform(tree, lambda s: F.concat_ws("/", F.transform(s, lambda p: F.concat_ws(",", p))))
    return F.concat(root_of(tree), F.lit(":"), F.concat_ws(";", body))


def _sections(fingerprint: Column) -> Column:
    return F.split(F.substring_index(fingerprint, ":", -1), ";", -1)


def _below(nodes: Column, mark: str) -> Column:
    """The children of all the nodes."""
    return F.flatten(F.transform(nodes, lambda x: F.split(x, mark, -1)))


def leaves_of(fingerprint: Column) -> Column:
    return F.split(F.translate(F.substring_index(fingerprint, ":", -1), ";/", ",,"), ",", -1)


def _shared(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of leaves."""
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints, 0 to 1."""
    return F.when(a == b, F.lit(1.0)).otherwise(_shared(leaves_of(a), leaves_of(b)))


def changed_leaves(a: Column, b: Column) -> Column:
    """The hashes of the leaves of ``a`` that ``b`` does not hold, from differing sections and paragraphs only."""
    sections = F.array_except(_sections(a), _sections(b))
    paragraphs = F.array_except(_below(sections, "/"), _below(_sections(b), "/"))
    found = F.array_except(_below(paragraphs, ","), leaves_of(b))
    return F.when(F.substring_index(a, ":", 1) == F.substring_index(b, ":", 1), F.array().cast("array<string>")).otherwise(found)


def differing_leaves(a: Column, b: Column) -> Column:
    """Where two texts differ: (section, paragraph, leaf) from 0 of the leaves of ``a`` that ``b`` does not hold."""
    nothing = F.array().cast("array<struct<section:int,paragraph:int,leaf:int>>")
    held, known = leaves_of(b), _sections(b)
    known_below = _below(known, "/")

    def place(s: Column, p: Column, k: Column) -> Column:
        return F.struct(s.alias("section"), p.alias("paragraph"), k.alias("leaf"))

    def in_paragraph(text: Column, s: Column, p: Column) -> Column:
        marked = F.transform(F.split(text, ",", -1), lambda x, k: F.when(~F.array_contains(held, x), place(s, p, k)))
        return F.when(F.array_contains(known_below, text), nothing).otherwise(F.filter(marked, lambda x: x.isNotNull()))

    def in_section(text: Column, s: Column) -> Column:
        inside = F.flatten(F.transform(F.split(text, "/", -1), lambda p, i: in_paragraph(p, s, i)))
        return F.when(F.array_contains(known, text), nothing).otherwise(inside)

    return F.when(a == b, nothing).otherwise(F.flatten(F.transform(_sections(a), in_section)))


def _above(cuts: list, value: Column) -> Column:
    """How many of the sorted ``cuts`` are above a value: whole blocks of cuts first, then inside the block it falls in."""
    if not cuts:
        return F.lit(0)
    literals = lambda xs: F.array(*map(F.lit, xs))
    blocks = [cuts[i : i + CUTS] for i in range(0, len(cuts), CUTS)]
    passed = F.size(F.filter(literals([b[-1] for b in blocks]), lambda c: c <= value))
    inside = F.get(F.array(*map(literals, blocks)), passed)
    below = F.when(passed < len(blocks), F.size(F.filter(inside, lambda c: c <= value))).otherwise(0)
    return F.lit(len(cuts)) - F.least(passed * CUTS + below, F.lit(len(cuts)))


def with_next(docs: DataFrame, id_col: str, text_col: str, carried: dict[str, Column]) -> DataFrame:
    """``(id, text, carried..., next_text, next_carried...)`` with the values of the following row by descending id.

    After the last row comes the first; null ids come last, and rows of one id are ordered by their text's md5. The
    ids are dealt out in ranges at approximate quantiles; a range is one sorted run, and the first row of the range that
    follows is added to its end, so rows cross the network once and no task sees all of them.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    n = rows.count()
    parts = max(1, min(RANGES, n // RANGE_ROWS))
    asked = [i / parts for i in range(1, parts)]
    cuts = rows.agg(F.percentile_approx("id", asked, 10 * RANGES).alias("q")).first()["q"] if asked else None
    cuts = sorted(set(cuts or ()))
    # ranges are numbered in the order of rows: 0 has the largest ids, and nulls come after all
    rows = rows.withColumn("range", F.when(F.col("id").isNull(), F.lit(len(cuts) + 1)).otherwise(_above(cuts, F.col("id"))).cast("int"))
    order = [F.col("id").desc_nulls_last(), F.md5(F.coalesce("text", F.lit(""))), F.col("text").asc_nulls_first()]
    # the first row of each range; there are at most RANGES + 2 of them
    first_ids = rows.groupBy("range").agg(F.max("id").alias("top"))
    firsts = rows.join(F.broadcast(first_ids), "range").where(F.col("id").eqNullSafe(F.col("top"))).drop("top")
    firsts = firsts.withColumn("h", F.md5(F.coalesce("text", F.lit(""))))
    firsts = firsts.groupBy("range").agg(F.min_by(F.struct("id", "text"), F.struct("h", F.col("text").isNotNull())).alias("f"))
    # the range before each range, among the few that are there; the last range comes before the first
    numbers = first_ids.select("range", F.lag("range").over(Window.orderBy("range")).alias("to"), F.max("range").over(Window.partitionBy()).alias("last"))
    tails = firsts.join(numbers, "range").select("f.id", "f.text", F.coalesce("to", "last").alias("range"), F.lit(1).alias("tail"))
    both = rows.withColumn("tail", F.lit(0)).unionByName(tails).withColumns(carried)
    window = Window.partitionBy("range").orderBy("tail", *order)
    out = both.withColumns({f"next_{c}": F.lead(c).over(window) for c in ("text", *carried)}).where("tail = 0")
    return out.drop("tail", "range")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they and the next document's are.

    Edited: the last floor(n_chars / 3) code points give way to as many (or all) from the start of the next document by
    descending id. ``n_changed`` counts the different leaves of the edited text that the text does not hold. One row for
    each row.
    """
    rows = with_next(docs, id_col, text_col, {})
    text, following = F.coalesce("text", F.lit("")), F.coalesce("next_text", F.lit(""))
    rows = rows.withColumn("n", F.length(text)).withColumn("k", F.floor(F.col("n") / 3).cast("int"))
    edited = F.concat(F.substring(text, F.lit(1), F.col("n") - F.col("k")), F.substring(following, F.lit(1), F.col("k")))
    rows = rows.withColumn("edited", edited)
    # trees, fingerprints and leaves are columns, so each is computed once
    rows = rows.withColumns({"t": tree(F.col("text")), "te": tree(F.col("edited")), "tn": tree(F.col("next_text"))})
    rows = rows.withColumns({"f": fingerprint_of(F.col("t")), "fe": fingerprint_of(F.col("te"))})
    rows = rows.withColumns({f"l{x}": F.flatten(F.flatten(x)) for x in ("t", "te", "tn")})
    # what likeness() gives for the fingerprints, from the leaves that they list
    near = lambda x: F.when(F.col("t") == F.col(x), F.lit(1.0)).otherwise(_shared(F.col("lt"), F.col(f"l{x}")))
    return rows.select(
        F.col("id").alias(id_col),
        F.col("n").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("f").alias("fingerprint"),
        F.col("fe").alias("edited_fingerprint"),
        near("te").alias("near_edited"),
        near("tn").alias("near_next"),
        F.size(changed_leaves(F.col("fe"), F.col("f"))).cast("long").alias("n_changed"),
    )
