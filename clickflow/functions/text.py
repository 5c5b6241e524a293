"""String helpers as column expressions (no Python in the row path)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_empty(s: Column) -> Column:
    return s.isNull() | (s == "")


def is_not_empty(s: Column) -> Column:
    return s.isNotNull() & (s != "")


def trim_comma(s: Column) -> Column:
    """Drop one leading and one trailing comma."""
    return F.regexp_replace(F.regexp_replace(s, "^,", ""), ",$", "")


def pad2(s: Column) -> Column:
    """Left-pad to two characters with ``0`` (longer text is unchanged)."""
    return F.when(F.length(s) < 2, F.lpad(s, 2, "0")).otherwise(s)


def concat_long_string(v1: Column, v2: Column, sep: str = ":") -> Column:
    """``v1 + sep + v2`` (the city-info label ``3:广州``)."""
    return F.concat_ws(sep, v1.cast("string"), v2)


def get_json_field(json_text: Column, field: str) -> Column:
    """Top-level JSON field as text (a number 0 reads as ``'0'``)."""
    return F.get_json_object(json_text, f"$.{field}")


def comma_list(s: Column) -> Column:
    """Comma text → array of items; null stays null."""
    return F.split(s, ",")


def kv_get(record: Column, field: str, delimiter: str = "|") -> Column:
    """Value of the first ``field=value`` segment whose value holds no ``=``; null if absent or empty.

    The delimiter may have several characters. Trailing ``=`` are allowed after the value (a split on ``=`` would drop them).
    """
    value = rf"^{re.escape(field)}=([^=]+)=*\z"
    segments = F.split(record, re.escape(delimiter), -1)
    return F.get(F.filter(F.transform(segments, lambda p: F.regexp_extract(p, value, 1)), lambda v: v != ""), F.lit(0))


def kv_set(record: Column, field: str, value: Column | str, delimiter: str = "|") -> Column:
    """Replace the value of every ``field=…`` segment; other segments keep their order.

    The field is never added when absent.
    """
    value = F.lit(value) if isinstance(value, str) else value
    prefix = f"{field}="
    parts = F.split(record, re.escape(delimiter))
    replaced = F.transform(
        parts,
        lambda p: F.when(p.startswith(prefix), F.concat(F.lit(prefix), value)).otherwise(p),
    )
    return F.array_join(replaced, delimiter)
