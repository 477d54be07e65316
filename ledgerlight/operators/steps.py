"""Step form of dense daily grids.

Between two bookings nothing changes: the days of a member's month are a few
steps, each with the number of days that it lasts. One row per (member, month)
holds the booked days (31 at most) as an array; it comes from the day totals by one
aggregation. Running totals, month totals and shares are worked out inside the
row, without a window, and

* ``steps`` gives one row per step, and ``weighted_days`` the days of months with
  bookings, each standing for one grid cell, and one row for all empty months
  of a member: what medians over the grid need (their ``weight``);
* ``spelled`` lists every day, for results that have a row per day. Months of
  a member without bookings are added there, as months.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.operators.joins import with_scalars

BOOKED = "booked"


def member_months(daily: DataFrame, date_col: str, keys: Sequence[str], value: str) -> DataFrame:
    """``keys, ano, mes, booked``: the booked days of a month as ``(dia, valor)``, in order; ``daily`` has one row per day and member."""
    d = F.col(date_col)
    day = F.struct(F.dayofmonth(d).alias("dia"), F.col(value).alias("valor"))
    return daily.groupBy(*keys, F.year(d).alias("ano"), F.month(d).alias("mes")).agg(F.sort_array(F.collect_list(day)).alias(BOOKED))


def _days_in_month() -> Column:
    return F.dayofmonth(F.last_day(F.make_date("ano", "mes", F.lit(1))))


def _sum(days: Column, of: str) -> Column:
    """Exact sum of the values of booked days."""
    zero = F.lit(0).cast(of)
    return F.aggregate(days, zero, lambda a, x: (a + x["valor"]).cast(of))


def _sum_type(df: DataFrame) -> str:
    """The type of a sum: ten digits more than the values for decimals, as in SUM."""
    t = df.schema[BOOKED].dataType.elementType["valor"].dataType
    return f"decimal({min(38, t.precision + 10)},{t.scale})" if t.typeName() == "decimal" else t.simpleString()


def steps(months: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, ano, mes, de, ate, gasto_mtd, total_do_mes``: from day ``de`` up to but without day ``ate`` the running total of the
    month is ``gasto_mtd``. A month that does not start with a booking begins with a step of zero. NULL keys have no steps,
    since grids are filled by equality."""
    of = _sum_type(months)
    known = months
    for k in keys:
        known = known.filter(F.col(k).isNotNull())
    starts = F.transform(BOOKED, lambda x: x["dia"])
    ends = F.concat(F.slice(starts, F.lit(2), F.greatest(F.size(BOOKED) - 1, F.lit(0))), F.array(_days_in_month() + 1))
    listed = F.transform(BOOKED, lambda x, i: F.struct(
        x["dia"].alias("de"), F.get(ends, i).alias("ate"), _sum(F.slice(BOOKED, F.lit(1), i + 1), of).alias("gasto_mtd")))
    lead = F.array(F.struct(F.lit(1).alias("de"), F.get(starts, F.lit(0)).alias("ate"), F.lit(0).cast(of).alias("gasto_mtd")))
    whole = F.when(F.get(starts, F.lit(0)) > 1, F.concat(lead, listed)).otherwise(listed)
    return (known.select(*keys, "ano", "mes", _sum(F.col(BOOKED), of).alias("total_do_mes"), F.explode(whole).alias("__s"))
            .select(*keys, "ano", "mes", "__s.de", "__s.ate", "__s.gasto_mtd", "total_do_mes"))


def before(found: DataFrame, cut: dt.date) -> DataFrame:
    """The steps of the days before ``cut``; month totals stay those of whole months."""
    month, last = F.col("ano") * 12 + F.col("mes"), cut.year * 12 + cut.month
    ate = F.when(month == last, F.least(F.col("ate"), F.lit(cut.day))).otherwise(F.col("ate"))
    return found.filter(month <= last).withColumn("ate", ate).filter(F.col("de") < F.col("ate"))


def spelled(months: DataFrame, members: DataFrame, span: DataFrame, keys: Sequence[str], date_col: str) -> DataFrame:
    """Every day of ``span`` (one row ``inicio, fim``) for every member:
    ``date_col, ano, mes, dia, keys, total_do_dia, gasto_mtd, total_do_mes``, zero where nothing was booked."""
    of = _sum_type(months)
    every = F.when(F.col("fim") >= F.col("inicio"), F.sequence(F.trunc("inicio", "MM"), F.trunc("fim", "MM"), F.expr("INTERVAL 1 MONTH")))
    grid = with_scalars(members.repartition(*keys), span).select(*keys, "inicio", "fim", F.explode(every).alias("__m"))
    own = months.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("ano").alias("__ano"), F.col("mes").alias("__mes"), BOOKED)
    grid = grid.select("*", F.year("__m").alias("ano"), F.month("__m").alias("mes"))
    on = (F.col("ano") == F.col("__ano")) & (F.col("mes") == F.col("__mes"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"__{k}"))
    kind = months.schema[BOOKED].dataType
    value = kind.elementType["valor"].dataType.simpleString()
    rows = grid.join(own, on, "left").withColumn(BOOKED, F.coalesce(BOOKED, F.array().cast(kind)))
    first = F.when(F.col("inicio") > F.col("__m"), F.dayofmonth("inicio")).otherwise(F.lit(1))
    last = F.least(_days_in_month(), F.datediff("fim", "__m") + 1)
    rows = rows.withColumn("total_do_mes", _sum(F.col(BOOKED), of))
    of_day = F.transform(F.sequence(first, last), lambda d: F.struct(
        d.alias("dia"), F.coalesce(F.get(F.filter(BOOKED, lambda x: x["dia"] == d), F.lit(0))["valor"], F.lit(0).cast(value)).alias("total_do_dia"),
        _sum(F.filter(BOOKED, lambda x: x["dia"] <= d), of).alias("gasto_mtd")))
    return (rows.select(*keys, "ano", "mes", "total_do_mes", F.explode(of_day).alias("__d"))
            .select(F.make_date("ano", "mes", "__d.dia").alias(date_col), "ano", "mes", "__d.dia", *keys, "__d.total_do_dia", "__d.gasto_mtd", "total_do_mes"))


def cells(members: DataFrame, span: DataFrame, keys: Sequence[str], cut: dt.date | None = None) -> DataFrame:
    """``keys, dia, celulas``: in how many months of ``span`` (before ``cut``) the day of month ``dia`` exists, for every member."""
    days = span.select(F.explode(F.when(F.col("fim") >= F.col("inicio"), F.sequence("inicio", "fim"))).alias("__d"))
    days = days.filter(F.col("__d") < F.lit(cut)) if cut else days
    counted = days.groupBy(F.dayofmonth("__d").alias("dia")).agg(F.count(F.lit(1)).alias("celulas"))
    listed = counted.agg(F.sort_array(F.collect_list(F.struct("dia", "celulas"))).alias("__days"))       # 31 at most
    return with_scalars(members, listed).select(*keys, F.explode("__days").alias("__x")).select(*keys, "__x.dia", "__x.celulas")


def weighted_days(found: DataFrame, every: DataFrame, keys: Sequence[str], days: Sequence[int] | None = None) -> DataFrame:
    """``dia, keys, gasto_mtd, total_do_mes, celulas``: the grid of ``every`` (``cells``) by weights. A day of a step is one cell;
    the cells of months without bookings are one row per member and day of month, with a running total of zero and no month total."""
    listed = F.sequence("de", F.col("ate") - 1)
    if days:
        listed = F.filter(listed, lambda d: d.isin(*days))
        every = every.filter(F.col("dia").isin(*days))
    booked = found.select(F.explode(listed).alias("dia"), *keys, "gasto_mtd", "total_do_mes").withColumn("celulas", F.lit(1).cast("long"))
    # listed and booked cells meet in one aggregation; NULL keys group as one
    empty = (every.select("dia", *keys, F.col("celulas").cast("long").alias("celulas"))
             .unionByName(booked.select("dia", *keys, (-F.col("celulas")).alias("celulas")))
             .groupBy("dia", *keys).agg(F.sum("celulas").alias("celulas")).filter("celulas > 0"))
    kinds = dict(found.dtypes)
    return booked.unionByName(empty.select("dia", *keys, F.lit(0).cast(kinds["gasto_mtd"]).alias("gasto_mtd"),
                                           F.lit(None).cast(kinds["total_do_mes"]).alias("total_do_mes"), "celulas"))
