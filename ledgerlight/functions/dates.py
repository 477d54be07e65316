"""Date helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_start(year, month) -> Column:
    return F.make_date(_c(year), _c(month), F.lit(1))


def month_end(year, month) -> Column:
    """EOMONTH(DATEFROMPARTS(year, month, 1))."""
    return F.last_day(month_start(year, month))


def year_month(year, month) -> Column:
    """year * 100 + month as int (e.g. 202411)."""
    return (_c(year) * 100 + _c(month)).cast("int")


def lookup_name(index, names: Sequence[str]) -> Column:
    """1-based lookup in a fixed list of names (locale-free)."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), _c(index).cast("int"))
