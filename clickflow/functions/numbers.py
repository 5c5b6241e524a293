"""Numeric helpers (column expressions only)."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_half_up(count: str, total: str, scale: int = 2) -> Column:
    """``count / total`` rounded half-up to ``scale`` places; null when ``total`` is 0.

    ``count`` and ``total`` are column names. Computed with integral division,
    ``(2·10^s·c + t) div (2·t) / 10^s``, so it is exact for any count and does not
    depend on how a double prints (0.285 must become 0.29).
    """
    p = 10**scale
    c, t = f"CAST(`{count}` AS BIGINT)", f"CAST(`{total}` AS BIGINT)"
    return F.expr(f"CASE WHEN {t} > 0 THEN CAST(({c} * {2 * p} + {t}) div ({t} * 2) AS DOUBLE) / {p} END")
