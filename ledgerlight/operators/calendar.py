"""Calendar dimensions (C1-C3), generated in parallel from ``spark.range``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight import schemas as S
from ledgerlight.functions.dates import lookup_name, year_month


def _as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def daily_calendar(spark: SparkSession, start, end) -> DataFrame:
    """One row per day in [start, end] (a column ``data`` of dates)."""
    s, e = _as_date(start), _as_date(end)
    n = (e - s).days + 1
    return spark.range(n).select(F.date_add(F.lit(s), F.col("id").cast("int")).alias("data"))


def covering_years(df: DataFrame, date_col: str) -> DataFrame:
    """One row ``(inicio, fim)``: Jan 1 of the first and Dec 31 of the last
    year present in ``date_col`` (NULLs if there is none); part of the plan,
    nothing reaches the driver."""
    first, last = F.min(date_col), F.max(date_col)
    return df.agg(F.trunc(first, "year").alias("inicio"),
                  F.date_sub(F.add_months(F.trunc(last, "year"), 12), 1).alias("fim"))


def days_of(span: DataFrame) -> DataFrame:
    """C1 for a one-row span: a column ``data`` with every day (none for a NULL span)."""
    return span.select(F.explode(F.sequence("inicio", "fim")).alias("data"))


def calendar_for(df: DataFrame, date_col: str) -> DataFrame:
    """C1 over the years of the data instead of fixed literals."""
    return days_of(covering_years(df, date_col))


def calendar_attributes(days: DataFrame, date_col: str = "data") -> DataFrame:
    """Weekday, workday flag, names, and semester/quarter/bimester keys."""
    d = F.col(date_col)
    y, m = F.year(d), F.month(d)
    sem = F.when(m <= 6, 1).otherwise(2)
    tri = F.quarter(d)
    bim = F.ceil(m / 2).cast("int")
    wd = F.dayofweek(d)                                 # 1 = Sunday ... 7 = Saturday
    return days.select(
        d.alias("data"),
        lookup_name(wd, S.WEEKDAY_NAMES).alias("dia_da_semana"),
        F.when(wd.isin(1, 7), F.lit(S.WORKDAY_NO)).otherwise(F.lit(S.WORKDAY_YES)).alias("dia_util"),
        y.alias("ano"), m.alias("mes"), F.dayofmonth(d).alias("dia"),
        lookup_name(m, S.MONTH_NAMES).alias("nome_do_mes"),
        F.concat(lookup_name(m, S.MONTH_ABBREVIATIONS), F.lit("/"),
                 F.lpad((y % 100).cast("string"), 2, "0")).alias("mes_ano"),
        year_month(y, m).alias("ano_mes"),
        sem.cast("int").alias("semestre"),
        F.concat(sem.cast("string"), F.lit("/"), y.cast("string")).alias("semestre_ano"),
        (y * 10 + sem).cast("int").alias("ano_semestre"),
        tri.alias("trimestre"),
        F.concat(tri.cast("string"), F.lit("/"), y.cast("string")).alias("trimestre_ano"),
        (y * 10 + tri).cast("int").alias("ano_trimestre"),
        bim.alias("bimestre"),
        F.concat(bim.cast("string"), F.lit("/"), y.cast("string")).alias("bimestre_ano"),
        (y * 10 + bim).cast("int").alias("ano_bimestre"),
    )


def dim_calendario(spark: SparkSession, start, end) -> DataFrame:
    return calendar_attributes(daily_calendar(spark, start, end))


def dim_mes(calendar: DataFrame, date_col: str = "data") -> DataFrame:
    """One row per month: ano_mes, ano, mes, first and last day."""
    d = F.col(date_col)
    return (calendar.select(F.trunc(d, "MM").alias("primeiro_dia")).distinct()
            .select(year_month(F.year("primeiro_dia"), F.month("primeiro_dia")).alias("ano_mes"),
                    F.year("primeiro_dia").alias("ano"), F.month("primeiro_dia").alias("mes"),
                    "primeiro_dia", F.last_day("primeiro_dia").alias("ultimo_dia")))
