"""Null- and zero-safe arithmetic (ANSI mode raises on x/0 and bad casts)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nullif(x, value=0) -> Column:
    """SQL NULLIF(x, value)."""
    x = _c(x)
    return F.when(x == F.lit(value), F.lit(None)).otherwise(x)


def safe_div(num, den) -> Column:
    """num / NULLIF(den, 0) in double precision; NULL when den is 0 or NULL."""
    return F.try_divide(_c(num).cast("double"), nullif(_c(den).cast("double"), 0.0))


def rnd(x, digits: int) -> Column:
    """Round a double half away from zero at ``digits`` decimals, computed as
    round(x * 10^digits) / 10^digits on the binary value. (Spark's
    ``round(x, d)`` rounds the shortest decimal text of the double, which
    splits ties like 0.45315 differently from engines that scale first.)"""
    m = float(10 ** digits)
    return F.round(_c(x).cast("double") * F.lit(m), 0) / F.lit(m)


def ratio(num, den, digits: int = 6) -> Column:
    """Rounded ratio: shares and percentages are never emitted unrounded."""
    return rnd(safe_div(num, den), digits)


def money(x) -> Column:
    """Exact decimal money value exposed as double (exact for <= 15 digits)."""
    return _c(x).cast("double")
