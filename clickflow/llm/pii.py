"""Format-preserving pseudonyms of personal data by a keyed Feistel permutation; DataFrame functions only.

Found values are validated (card check digit, octets up to 255, calendar dates, assignable number ranges) and then
permuted within their own format: a value of a domain of a * b values is split as hi * b + lo, and in each round one
half is shifted by a keyed hash of the other, modulo its own size. So the result is again valid, keeps its separators,
and equal values stay equal in all documents. What fails validation is left as it is.

- cards (13 to 19 digits: joined, in groups of 4-4-4-4, 4-4-4-4-3, 4-6-4 or 4-6-5, or in any groups if no other digits
  stand beside them; spaces and hyphens alike): the first digit stays, the check digit is made anew;
- North American phone numbers, looked for before cards; with ``+1`` or brackets also those whose area code begins with 0
  or 1, which keep such an area code; social security numbers; IPv4 addresses;
- dates ``YYYY-MM-DD``, ``DD.MM.YYYY`` and ``MM/DD/YYYY`` of the 400 years from 1800 on;
- e-mail addresses are not numbers: they become ``u<keyed hash>@anon.invalid``.

Null texts stay null with counts of 0. Texts of any length are searched whole; the search takes time in proportion to the
text, but for texts that hold many different cards: their number times the places that can start one are tried (4,000 cards
in one text took 4 s). An empty table gives no rows; other columns are not read. Rows are independent, so repeated rows give repeated results. The key is a
parameter; whoever has it can undo the numbers and dates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
#: A domain has at most 127 labels (253 characters); the bound also keeps the regular expression from recursing deeper.
EMAIL = r"[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.){1,127}[A-Za-z]{2,}"
DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4}"
IP = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
#: ``+1`` or brackets name a phone number whatever its area code; without them the area code must be assignable.
PHONE = r"(?:(?:\+1[ .-]?)?\([0-9]{3}\)|\+1[ .-]?[0-9]{3}|[2-9][0-9]{2})[ .-]?[0-9]{3}[ .-][0-9]{4}"
CARD = r"[0-9](?:[ -]?[0-9]){12,18}"
#: How cards are written, the usual ways first; the last one is any grouping of digits that stand alone.
CARD_SHAPES = (
    r"[0-9]{13,19}", r"[0-9]{4}(?:[ -][0-9]{4}){3}", r"[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}", r"[0-9]{4}(?:[ -][0-9]{4}){3}[ -][0-9]{3}",
    rf"(?<![0-9][ -]){CARD}(?![ -][0-9])",
)
#: What digits alone may be is bounded by what stands before and after them.
ANY = rf"(?<![A-Za-z0-9._%+-]){EMAIL}|(?<![0-9.])(?:{DATE}|{IP})(?![0-9]|\.[0-9])|(?<![0-9+-]){SSN}(?![0-9-])|(?<![0-9])(?:{PHONE})(?![0-9])"
KINDS = ("email", "date", "ip", "ssn", "phone", "card")
#: The calendar repeats after 400 years, which are 189 * 773 days.
FIRST_DAY, DAYS_HI, DAYS_LO = "1800-01-01", 189, 773


def feistel(value: Column, hi: Column | int, lo: Column | int, key: str, kind: str, rounds: int = ROUNDS) -> Column:
    """The keyed permutation of 0 .. hi * lo - 1 at ``value``."""
    hi, lo = (F.lit(x).cast("long") if isinstance(x, int) else x for x in (hi, lo))
    low = F.pmod(value, lo)
    # an exact quotient: the decimals have no fraction
    high = ((value - low).cast("decimal(20,0)") / lo.cast("decimal(20,0)")).cast("long")
    start = F.struct(high.alias("h"), low.cast("long").alias("l"))

    def shift(i: Column, half: Column, size: Column) -> Column:
        digest = F.sha2(F.concat_ws(":", F.lit(key), F.lit(kind), i.cast("string"), half.cast("string")), 256)
        return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), size)

    def step(s: Column, i: Column) -> Column:
        even = F.pmod(i, F.lit(2)) == 0
        return F.struct(
            F.when(even, F.pmod(s["h"] + shift(i, s["l"], hi), hi)).otherwise(s["h"]).alias("h"),
            F.when(even, s["l"]).otherwise(F.pmod(s["l"] + shift(i, s["h"], lo), lo)).alias("l"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, step, lambda s: s["h"] * lo + s["l"])


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), then)[0]


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced one by one by ``digits``."""
    return _let(digits, lambda d: _filled(shape, d))


def _filled(shape: Column, digits: Column) -> Column:
    at = F.sequence(F.lit(1), F.length(shape))
    return F.concat_ws("", F.transform(at, lambda i: F.when(
        F.rlike(F.substring(shape, i, F.lit(1)), F.lit("[0-9]")),
        F.substring(digits, F.length(_digits(F.substring(shape, F.lit(1), i))), F.lit(1)),
    ).otherwise(F.substring(shape, i, F.lit(1)))))


def _luhn_sum(digits: Column, doubled_from_right: int) -> Column:
    """Sum of the digits, every second one (from the right, 0 or 1 first) doubled."""
    n = F.length(digits)
    each = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(digits, i, F.lit(1)).cast("int") * F.when(F.pmod(n - i, F.lit(2)) == doubled_from_right, 2).otherwise(1))
    return F.aggregate(each, F.lit(0), lambda s, x: s + F.when(x > 9, x - 9).otherwise(x))


def _power_of_ten(n: Column) -> Column:
    return F.concat(F.lit("1"), F.repeat(F.lit("0"), n)).cast("long")


def _card_valid(digits: Column) -> Column:
    return F.pmod(_luhn_sum(digits, 1), F.lit(10)) == 0


def _searched(text: Column) -> Column:
    """The pattern to search ``text`` for: ``ANY``, and the valid cards of the text word for word.

    Cards are tried from every digit that starts a group, in every shape, and only valid ones enter the pattern: digits
    that fail the check swallow nothing that stands beside them.
    """
    tried = F.concat(*(F.regexp_extract_all(text, F.lit(rf"(?<![0-9])(?=({shape})(?![0-9]))"), F.lit(1)) for shape in CARD_SHAPES))
    cards = F.filter(F.array_distinct(tried), lambda m: _card_valid(_digits(m)))
    with_cards = _let(cards, lambda c: F.when(F.size(c) > 0, F.concat(F.lit(rf"{ANY}|(?<![0-9])(?=[0-9])(?:"), F.array_join(c, "|"), F.lit(")(?![0-9])"))))
    return F.coalesce(F.when(F.rlike(text, F.lit(r"[0-9](?:[ -]?[0-9]){12}")), with_cards), F.lit(ANY))


def _card(m: Column, key: str) -> Column:
    d = _digits(m)
    inner = F.substring(d, F.lit(2), F.length(d) - 2)
    n = F.length(inner)
    left = F.floor(n / 2).cast("int")
    new = feistel(inner.cast("long"), _power_of_ten(left), _power_of_ten(n - left), key, "card")
    body = F.concat(F.substring(d, 1, 1), F.lpad(new.cast("string"), n, F.lit("0")))
    checked = lambda b: F.concat(b, F.pmod(F.lit(10) - F.pmod(_luhn_sum(b, 0), F.lit(10)), F.lit(10)).cast("string"))
    return F.when(_card_valid(d) & (F.length(d) >= 13), _refill(m, _let(body, checked)))


def _phone(m: Column, key: str) -> Column:
    d = _digits(m)
    ten = F.substring(d, F.length(d) - 9, F.lit(10)).cast("long")
    # two permutations, so that an area code that is not assignable stays so and no two numbers become one
    assignable = feistel(ten - 2_000_000_000, 80_000, 100_000, key, "phone") + 2_000_000_000
    new = F.when(ten >= 2_000_000_000, assignable).otherwise(feistel(ten, 20_000, 100_000, key, "phone0"))
    return _refill(m, F.concat(F.substring(d, F.lit(1), F.length(d) - 10), F.lpad(new.cast("string"), 10, "0")))


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substring(m, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    low, pairs = F.when(area < 666, area - 1).otherwise(area - 2), 99 * 9999
    new = feistel(low * pairs + (group - 1) * 9999 + serial - 1, 898, pairs, key, "ssn")

    def written(v: Column) -> Column:
        rest = F.pmod(v, F.lit(pairs))
        a = ((v - rest) / pairs).cast("long")
        s = F.pmod(rest, F.lit(9999))
        return F.format_string("%03d-%02d-%04d", F.when(a < 665, a + 1).otherwise(a + 2), ((rest - s) / 9999).cast("long") + 1, s + 1)

    made = _let(new, written)
    return F.when((area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0), made)


def _ip(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda s, x: s * 256 + x)
    new = feistel(number, 65536, 65536, key, "ip")
    made = _let(new, lambda v: F.concat_ws(".", *(F.pmod(F.shiftright(v, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0))))
    return F.when(F.forall(octets, lambda x: x <= 255), made)


def _date(m: Column, key: str) -> Column:
    out = F.lit(None).cast("string")
    for pattern, shape in (("yyyy-MM-dd", r"^[0-9]{4}-"), ("dd.MM.yyyy", r"^[0-9]{2}\."), ("MM/dd/yyyy", r"^[0-9]{2}/")):
        day = F.try_to_timestamp(m, F.lit(pattern)).cast("date")
        at = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
        new = feistel(at, DAYS_HI, DAYS_LO, key, "date").cast("int")
        inside = (at >= 0) & (at < DAYS_HI * DAYS_LO)
        made = F.when(inside, F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), new), pattern))
        out = F.when(F.rlike(m, F.lit(shape)), made).otherwise(out)
    return out


def _named(m: Column, key: str) -> Column:
    """A struct (kind, value) for one found string; kind is null where validation fails."""
    hashed = F.substring(F.sha2(F.concat(F.lit(key + ":email:"), F.lower(m)), 256), 1, 12)
    whole = lambda p: F.rlike(m, F.lit(f"^(?:{p})$"))
    pick = F.when(F.instr(m, "@") > 0, F.struct(F.lit("email").alias("kind"), F.concat(F.lit("u"), hashed, F.lit("@anon.invalid")).alias("value")))
    for kind, pattern, make in (("date", DATE, _date), ("ip", IP, _ip), ("ssn", SSN, _ssn), ("phone", PHONE, _phone), ("card", CARD, _card)):
        pick = pick.when(whole(pattern), F.struct(F.lit(kind).alias("kind"), make(m, key).alias("value")))
    return _let(pick, lambda p: F.struct(F.when(p["value"].isNotNull(), p["kind"]).alias("kind"), F.coalesce(p["value"], m).alias("value")))


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row: ``(id_col, text_col, n_email, n_date, n_ip, n_ssn, n_phone, n_card)``, the text rewritten."""
    # the pattern needs a digit or an at sign: other texts are not searched
    some = F.rlike(F.col("t"), F.lit("[0-9@]"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).withColumn("pattern", F.when(some, _searched(F.col("t"))))
    found = F.when(some, F.regexp_extract_all("t", F.col("pattern"), F.lit(0))).otherwise(F.array().cast("array<string>"))
    rows = rows.select("id", "t", "pattern", F.transform(found, lambda m: _named(m, key)).alias("hits"))
    between = F.split("t", F.col("pattern"), -1)
    values = F.concat(F.transform("hits", lambda h: h["value"]), F.array(F.lit("")))
    joined = F.concat_ws("", F.flatten(F.zip_with(between, values, lambda p, v: F.array(p, v))))
    counts = {f"n_{k}": F.size(F.filter("hits", lambda h: h["kind"] == k)).cast("long") for k in KINDS}
    rows = rows.withColumns(counts).withColumn("t", F.when(F.size("hits") > 0, joined).otherwise(F.col("t")))
    return rows.select(F.col("id").alias(id_col), F.col("t").alias(text_col), *counts)
