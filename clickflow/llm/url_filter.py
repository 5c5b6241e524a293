"""URL filter: host and path rules, with block decisions carried over redirect and canonical-link edges.

DataFrame functions only. A url's own rule decides first (the longest that fits), so an explicit allow always holds.
A url without a rule is blocked if any url of its component of aliases is blocked by a rule, and allowed otherwise; the
urls that pages name count whether they are rows themselves or not.

Alias edges: a url and what its page names by ``<link rel="canonical">`` or a ``refresh`` meta redirect, and a url and
its canonical form (scheme, fragment, tracking parameters, a trailing slash and ``.html`` dropped, the host lower-cased
and without ``www.`` or ``m.``). A component is a connected component over the 128-bit hashes of these strings. What a page
names is first resolved against the page's url (other host, path from the root, relative path with dot segments, query
or fragment alone); a target of a scheme without ``://``, like ``mailto:``, leads to no page.

A null url, or one without ``://``, has empty host and path, no rule and no aliases, and is allowed. Repeated rows give
repeated results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (verdict, host, path); the list is a parameter of at most some thousand rules, held in the expression.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
CANONICAL = r'(?i)<link\b[^>]*\brel\s*=\s*["\x27]?canonical\b[^>]*>'
REFRESH = r'(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*["\x27]?refresh\b[^>]*>'
HREF = r'(?i)\bhref\s*=\s*["\x27]?([^"\x27\s>]+)'
TARGET = r'(?i)\burl\s*=\s*["\x27]?([^"\x27\s>]+)'
TRACKING = r"([?&])(?:utm_[a-z]+|ref)=[^&]*"


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("`__url`")))


def url_parts(df: DataFrame, url_col: str) -> DataFrame:
    """Adds ``host`` and ``path`` (empty for a null url or one without ``://``)."""
    rest = _after_scheme(F.col("__url"))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return df.withColumn("__url", F.col(url_col)).withColumns({"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit(""))}).drop("__url")


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """A struct (verdict, rule) of the longest rule that fits, or null."""
    best = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        best = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + rule_path).alias("rule"))).otherwise(best)
    return best


def canonical_form(url: Column) -> Column:
    rest = F.regexp_replace(F.regexp_replace(url, r"^[^:]*://", ""), r"#.*$", "")
    host = F.regexp_replace(F.translate(F.regexp_extract(rest, r"^([^/?]*)", 1), UPPER, LOWER), r"^(?:www|m)\.", "")
    tail = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*(.*)$", 1), TRACKING, "$1")
    tail = F.regexp_replace(F.regexp_replace(tail, r"[?&]+$", ""), r"(?:\.html|/)$", "")
    return F.concat(host, tail)


def resolved(target: Column, url: Column) -> Column:
    """The url that ``target`` names on the page ``url``, which has a scheme; null if it names no page."""
    scheme, site = F.regexp_extract(url, r"^([^:]*:)//", 1), F.regexp_extract(url, r"^([^:]*://[^/?#]*)", 1)
    page = F.regexp_extract(url, r"^([^?#]*)", 1)
    folder = F.regexp_extract(url, r"^[^:]*://[^/?#]*((?:[^?#]*/)?)", 1)
    path = F.when(F.startswith(target, F.lit("/")), target).otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), target))
    steps = F.split(F.regexp_extract(path, r"^([^?#]*)", 1), "/", -1)
    # the first step is the empty one before the root; there is nothing above it
    up = lambda at: F.slice(at, F.lit(1), F.greatest(F.size(at) - 1, F.lit(1)))
    walked = F.aggregate(steps, F.array().cast("array<string>"), lambda at, x: F.when(x == "..", up(at)).when(x == ".", at).otherwise(F.concat(at, F.array(x))))
    ends = F.when(F.element_at(steps, -1).isin(".", "..") | (F.size(walked) < 2), F.lit("/")).otherwise(F.lit(""))
    dotted = F.rlike(path, F.lit(r"^[^?#]*/\.\.?(?:[/?#]|$)"))
    path = F.when(dotted, F.concat(F.array_join(walked, "/"), ends, F.regexp_extract(path, r"^[^?#]*(.*)$", 1))).otherwise(path)
    return (
        F.when(F.rlike(target, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*://")), target)
        .when(F.rlike(target, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*:")), F.lit(None).cast("string"))
        .when(F.startswith(target, F.lit("//")), F.concat(scheme, target))
        .when(F.startswith(target, F.lit("?")), F.concat(page, target))
        .when(F.startswith(target, F.lit("#")), F.regexp_extract(url, r"^([^#]*)", 1))
        .otherwise(F.concat(site, path))
    )


def named_targets(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(url, to)``: the urls that pages name as canonical or redirect to."""
    html = F.col("html")
    link = F.regexp_extract(F.regexp_extract(html, CANONICAL, 0), HREF, 1)
    meta = F.regexp_extract(F.regexp_extract(html, REFRESH, 0), TARGET, 1)
    # a page without either tag is found by one pass over its text
    tagged = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html")).where((F.instr("url", "://") > 0) & html.rlike(r"(?i)canonical|refresh"))
    rows = tagged.select("url", F.explode(F.array(link, meta)).alias("to")).where("to != ''")
    return rows.select("url", resolved(F.col("to"), F.col("url")).alias("to")).where("to IS NOT NULL")


def _form_node(url: Column) -> Column:
    return F.md5(F.concat(F.lit("c:"), canonical_form(url)))


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(src, dst)`` hashes of urls that lead to the same page."""
    urls = pages.select(F.col(url_col).alias("url")).where((F.instr("url", "://") > 0) & (canonical_form(F.col("url")) != ""))
    # a target is a url too: it meets others by its own canonical form
    both = urls.withColumn("to", F.col("url")).unionByName(named_targets(pages, url_col, html_col))
    return both.select(F.md5(F.col("url")).alias("src"), _form_node(F.col("to")).alias("dst")).distinct()


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=RULES) -> DataFrame:
    """One row for each page: ``(id_col, host, path, rule, verdict, by_alias)``."""
    narrow = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    ruled = url_parts(narrow, "url").withColumn("own", fitting_rule(F.col("host"), F.col("path"), rules))
    ruled = ruled.withColumn("node", F.when(F.instr("url", "://") > 0, F.md5(F.col("url"))))
    comp = connected_components(alias_edges(pages, url_col, html_col), "src", "dst")
    # a target has its rule by its own host and path, whether it was crawled or not
    targets = url_parts(named_targets(pages, url_col, html_col), "to").withColumn("own", fitting_rule(F.col("host"), F.col("path"), rules))
    targets = targets.where("own.verdict = 'block'").select(_form_node(F.col("to")).alias("node"))
    blocked = ruled.where("own.verdict = 'block'").select("node").unionByName(targets).distinct()
    bad = comp.join(blocked, "node", "left_semi").select("component").distinct()
    aliases = comp.join(bad, "component", "left_semi").select("node", F.lit(True).alias("by_alias"))
    out = ruled.join(aliases, "node", "left").withColumn("by_alias", F.col("own").isNull() & F.coalesce("by_alias", F.lit(False)))
    verdict = F.coalesce(F.col("own.verdict"), F.when(F.col("by_alias"), F.lit("block")).otherwise(F.lit("allow")))
    return out.select(F.col("id").alias(id_col), "host", "path", F.col("own.rule").alias("rule"), verdict.alias("verdict"), "by_alias")
