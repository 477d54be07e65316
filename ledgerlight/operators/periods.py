"""Period metrics (W1-W20): YTD/MTD, MoM/YoY changes, shares, group means,
atypical flags.

These windows run on PRE-AGGREGATED rows (one per month or per day and
member), so a window partition holds at most the months or days of one
member, or the members of one dimension in one month: bounded by the
dimensions, never by the number of ledger rows. No window is keyed by the
month alone; month totals are partial aggregates joined back. Running totals over raw ledger rows use
``operators.running.running_sum`` instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight import schemas as S
from ledgerlight.functions.safe import nullif, rnd


def cumulative(value: str | Column, partition: Sequence, order: Sequence) -> Column:
    """SUM(value) OVER (PARTITION BY p ORDER BY o ROWS UNBOUNDED PRECEDING)."""
    v = F.col(value) if isinstance(value, str) else value
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return F.sum(v).over(w)


def ytd(df: DataFrame, value: str, partition: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Year-to-date (partition includes the year)."""
    return df.withColumn(out, cumulative(value, partition, order))


def lagged(value: str | Column, partition: Sequence, order: Sequence, offset: int) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return F.lag(v, offset).over(Window.partitionBy(*partition).orderBy(*order))


def change_abs(value: Column, previous: Column) -> Column:
    """V - NULLIF(prev, 0) (prev 0 gives NULL, not v)."""
    return value - nullif(previous, 0)


def change_pct(value: Column, previous: Column, digits: int = 6) -> Column:
    """V / NULLIF(prev, 0) - 1."""
    return rnd(F.try_divide(value.cast("double"), nullif(previous, 0).cast("double")) - 1, digits)


def calendar_lagged(value: str | Column, members: Sequence, month_index: Column, offset: int) -> Column:
    """The member's value ``offset`` months earlier on the calendar (NULL if
    that month has no row): a range window over the month index, for one row
    per member and month."""
    v = F.col(value) if isinstance(value, str) else value
    w = Window.partitionBy(*members).orderBy(month_index).rangeBetween(-offset, -offset)
    return F.max(v).over(w)


def period_change(df: DataFrame, value: str, members: Sequence[str], year: str, month: str,
                  offset: int, out_abs: str, out_pct: str, mode: str = "rows") -> DataFrame:
    """MoM (offset 1) / YoY (offset 12) change of a monthly series.

    ``mode="rows"``: LAG counts rows of the member's series, as the
    reference's SQL does (a month without entries is skipped).
    ``mode="calendar"``: compares with the calendar month ``offset`` months
    earlier (NULL if that month has no row).
    """
    v = F.col(value)
    if mode == "rows":
        prev = lagged(value, members, [year, month], offset)
    elif mode == "calendar":
        prev = calendar_lagged(value, members, F.col(year) * 12 + F.col(month), offset)
    else:
        raise ValueError(mode)
    return (df.withColumn("__prev", prev).withColumn(out_abs, change_abs(v, F.col("__prev")).cast("double"))
              .withColumn(out_pct, change_pct(v, F.col("__prev"))).drop("__prev"))


def month_totals(df: DataFrame, value: str | Column, keys: Sequence[str], out: str) -> DataFrame:
    """SUM(value) per ``keys``, which name a month (and perhaps a status)."""
    return df.groupBy(*keys).agg(F.sum(F.col(value) if isinstance(value, str) else value).alias(out))


def with_month_total(df: DataFrame, value: str | Column, keys: Sequence[str], out: str, totals: DataFrame | None = None) -> DataFrame:
    """Attach SUM(value) per ``keys``, which name a month (and perhaps a
    status): a partial aggregate joined back, never a window over a month.
    ``totals`` (``month_totals``) says them where they are found more cheaply than
    from ``df``, e.g. over the rows that it was grouped from.

    The totals are broadcast: the load rules bound the months by the ledger's
    and the calendar's date range, and statuses are a fixed list.
    """
    totals = month_totals(df, value, keys, out) if totals is None else totals
    side = totals.select(*[F.col(k).alias(f"__m_{k}") for k in keys], out)
    on = [F.col(k) == F.col(f"__m_{k}") for k in keys]
    return df.join(F.broadcast(side), on, "left").select(*df.columns, out)


def share(value: str | Column, part: Sequence, total: str, digits: int = 6, guard_numerator: bool = False) -> Column:
    """SUM(v) OVER (part) / NULLIF(total, 0). ``part`` is a month and
    one member, so a window holds at most the other dimension's members."""
    v = F.col(value) if isinstance(value, str) else value
    num = F.sum(v).over(Window.partitionBy(*part))
    if guard_numerator:
        num = nullif(num, 0)
    return rnd(F.try_divide(num.cast("double"), nullif(F.col(total), 0).cast("double")), digits)


def share_of_total(df: DataFrame, value: str, total_keys: Sequence[str], out: str,
                   digits: int = 6, totals: DataFrame | None = None) -> DataFrame:
    """Row value / total of its month, the total attached by ``with_month_total`` (``totals``: as ``__tot``)."""
    j = with_month_total(df, value, total_keys, "__tot", totals)
    return j.select(*df.columns, rnd(F.try_divide(F.col(value).cast("double"),
                                                      F.col("__tot").cast("double")), digits).alias(out))


def group_mean(value: str | Column, partition: Sequence, ignore_zero: bool = False) -> Column:
    """AVG(v) OVER (partition), optionally AVG(NULLIF(v, 0)); exact
    sum over count, exposed as double."""
    v = F.col(value) if isinstance(value, str) else value
    if ignore_zero:
        v = nullif(v, 0)
    w = Window.partitionBy(*partition)
    return F.try_divide(F.sum(v).over(w).cast("double"), F.count(v).over(w).cast("double"))


def atypical_two_way(value: Column, mean: Column, high: float = S.ATYPICAL_HIGH_FACTOR,
                     low: float = S.ATYPICAL_LOW_FACTOR) -> Column:
    """Above high x mean or below low x mean -> atypical, else normal."""
    v = value.cast("double")
    return F.when((v > high * mean) | (v < low * mean), F.lit(S.ATYPICAL)).otherwise(F.lit(S.NORMAL))


def atypical_three_way(value: Column, mean: Column, high: float = S.ATYPICAL_HIGH_FACTOR,
                       low: float = S.ATYPICAL_LOW_FACTOR) -> Column:
    """Above / below / normal (NULL compares unknown -> normal)."""
    v = value.cast("double")
    return (F.when(v > high * mean, F.lit(S.ABOVE_NORMAL))
            .when(v < low * mean, F.lit(S.BELOW_NORMAL))
            .otherwise(F.lit(S.NORMAL)))
