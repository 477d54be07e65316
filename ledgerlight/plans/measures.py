"""Dashboard measures (M1-M21) as DataFrame operators.

The reference computes these in a BI tool's filter context. Here every
measure takes an explicit as-of date and grain (``Config.as_of``); nothing
calls ``current_date()``. All inputs are aggregated first (per cost centre,
category, day or month), so the joins and windows below work on
dimension-bounded tables; the only per-entry work is the partial
aggregation of the ledger.
"""

from __future__ import annotations

import calendar as pycal
import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight import schemas as S
from ledgerlight.functions.safe import money, nullif, rnd
from ledgerlight.operators import ranking
from ledgerlight.operators.joins import bounded, runtime_sized, with_scalars
from ledgerlight.plans import gold
from ledgerlight.plans.config import Config
from ledgerlight.plans.silver import Silver

ALL = S.ALL_MEMBERS


@dataclass(frozen=True)
class Period:
    as_of: dt.date
    month_start: dt.date
    day: int
    days_in_month: int
    year: int
    month: int
    as_of_ly: dt.date
    month_start_ly: dt.date

    @staticmethod
    def of(cfg: Config) -> "Period":
        a = cfg.as_of
        dim = pycal.monthrange(a.year, a.month)[1]
        ly_day = min(a.day, pycal.monthrange(a.year - 1, a.month)[1])
        return Period(a, a.replace(day=1), a.day, dim, a.year, a.month,
                      dt.date(a.year - 1, a.month, ly_day), dt.date(a.year - 1, a.month, 1))


# ------------------------------------------------------------------ building blocks
def actual_between(sv: Silver, start: dt.date, end: dt.date, keys: list[str]) -> DataFrame:
    fl = sv.entries_between(start, end)
    return fl.groupBy(*keys).agg(F.sum("valor").alias("realizado"), F.count(F.lit(1)).alias("qtd_lancamentos"))


def budget_month(sv: Silver, year: int, month: int, keys: list[str]) -> DataFrame:
    fo = sv.fact_orcamento.filter((F.col("ano") == year) & (F.col("mes") == month))
    return fo.groupBy(*keys).agg(F.sum("valor").alias("orcado"))


def weights(ref: DataFrame, cc: bool, cat: bool, days: list[int]) -> DataFrame:
    """The benchmark at one grain (-999 = all) as one row per member: ``__w``
    maps the wanted days to their peso_do_dia, ``__v`` to the median value.
    All weights of a measure come from this one frame; a map holds at most 31 days."""
    cond = F.col("dia").isin(*days)
    cond &= (F.col("id_centro_custo") != ALL) if cc else (F.col("id_centro_custo") == ALL)
    cond &= (F.col("id_categoria") != ALL) if cat else (F.col("id_categoria") == ALL)
    keys = (["id_centro_custo"] if cc else []) + (["id_categoria"] if cat else [])

    def by_day(value: str, name: str) -> Column:
        return F.map_from_entries(F.collect_list(F.struct("dia", value))).alias(name)

    return ref.filter(cond).groupBy(*keys).agg(by_day("peso_do_dia", "__w"), by_day("valor_mediano_dia", "__v"))


def benchmark_for(sv: Silver, cfg: Config, cc: bool, cat: bool, days: list[int]) -> DataFrame:
    """G4 at the one grain and the days that a measure needs."""
    keys = (["id_centro_custo"] if cc else []) + (["id_categoria"] if cat else [])
    return gold.gold_referencia_mtd(sv, cfg, sets=[keys], days=days)


def projections(base: DataFrame, ref: DataFrame, p: Period, cfg: Config, cc: bool, cat: bool,
                days: list[int] | None = None) -> DataFrame:
    """M4/M5/M6 finals: linear, historical and hybrid closing projections; ``__w`` keeps the weights by day."""
    keys = (["id_centro_custo"] if cc else []) + (["id_categoria"] if cat else [])
    w = weights(ref, cc, cat, sorted({p.day, p.days_in_month, *(days or [])}))
    b = base.join(runtime_sized(w), keys, "left") if keys else with_scalars(base, w)
    b = b.withColumn("__w_now", F.try_element_at("__w", F.lit(p.day))).withColumn("__w_final", F.try_element_at("__w", F.lit(p.days_in_month)))
    r = money("realizado")
    linear = r / F.lit(p.day) * F.lit(p.days_in_month)
    hist = F.try_divide(r, nullif(F.col("__w_now"), 0.0)) * F.col("__w_final")
    final = F.lit(cfg.linear_weight) * linear + F.lit(cfg.historical_weight) * F.coalesce(hist, linear)
    return (b.withColumn("__linear", linear).withColumn("__hist", hist).withColumn("__final", final))


def pace_status(projected: Column, budget: Column, tol: float) -> Column:
    b = F.coalesce(budget, F.lit(0.0))
    return (F.when(projected > b * (1 + tol), F.lit(S.PACE_OVER))
            .when(projected < b * (1 - tol), F.lit(S.PACE_UNDER))
            .otherwise(F.lit(S.PACE_ON)))


def risk_light(actual: Column, budget: Column, amber: float) -> Column:
    a = F.coalesce(actual, F.lit(0.0))
    return (F.when(a > F.coalesce(budget, F.lit(0.0)), F.lit(S.RISK_RED))
            .when(a >= budget * amber, F.lit(S.RISK_AMBER))
            .otherwise(F.lit(S.RISK_GREEN)))


# ------------------------------------------------------------------ M1 .. M21
def kpis(sv: Silver, cfg: Config, keys: list[str]) -> DataFrame:
    """M1 at any grain: month budget, actual to date and entry count per ``keys`` (none: the company)."""
    p = Period.of(cfg)
    o = budget_month(sv, p.year, p.month, keys)
    r = actual_between(sv, p.month_start, p.as_of, keys)
    j = o.join(r, keys, "full_outer") if keys else with_scalars(o, r)
    return j.select(*keys, money("orcado").alias("orcado"), money("realizado").alias("realizado"),
                    F.coalesce(F.col("qtd_lancamentos"), F.lit(0)).alias("qtd_lancamentos"))


def kpis_by_cost_centre(sv: Silver, cfg: Config) -> DataFrame:
    """M1 per cost centre."""
    return kpis(sv, cfg, ["id_centro_custo"])


def company_cards(sv: Silver, cfg: Config) -> DataFrame:
    """The company's cards: month budget, actual to date and of the whole month, variance, and the changes against
    the month before, the same days of the last year and the year to date. One conditional aggregate of the ledger."""
    p = Period.of(cfg)
    before = p.month_start - dt.timedelta(days=1)
    day = F.col("data_lancamento")

    def total(start: dt.date, end: dt.date, name: str) -> Column:
        return F.sum(F.when(day.between(F.lit(start), F.lit(end)), F.col("valor"))).alias(name)

    first = min(dt.date(p.year - 1, 1, 1), before.replace(day=1))
    r = sv.entries_between(first, p.as_of.replace(day=p.days_in_month)).agg(
        total(p.month_start, p.as_of, "mtd"), total(p.month_start, p.as_of.replace(day=p.days_in_month), "mes"),
        total(before.replace(day=1), before, "mes_anterior"), total(p.month_start_ly, p.as_of_ly, "mtd_ano_anterior"),
        total(dt.date(p.year, 1, 1), p.as_of, "ytd"), total(dt.date(p.year - 1, 1, 1), p.as_of_ly, "ytd_ano_anterior"))
    j = with_scalars(budget_month(sv, p.year, p.month, []), r)

    def change(now: str, then: str) -> Column:
        return rnd(F.try_divide(F.col(now).cast("double"), nullif(F.col(then), 0).cast("double")) - 1, 6)

    zero = F.lit(0)
    return j.select(money("orcado").alias("orcado"), money("mtd").alias("realizado"), money("mes").alias("realizado_mes"),
                    money(F.coalesce("mtd", zero) - F.coalesce("orcado", zero)).alias("desvio"),
                    money("mes_anterior").alias("realizado_mes_anterior"), change("mes", "mes_anterior").alias("mom_perc"),
                    money("mtd_ano_anterior").alias("realizado_ano_anterior"), change("mtd", "mtd_ano_anterior").alias("yoy_perc"),
                    money("ytd").alias("realizado_ytd"), money("ytd_ano_anterior").alias("realizado_ytd_ano_anterior"),
                    change("ytd", "ytd_ano_anterior").alias("ytd_perc"))


def consumption(sv: Silver, cfg: Config) -> DataFrame:
    """M2: % of budget consumed and % of month elapsed."""
    p = Period.of(cfg)
    k = kpis_by_cost_centre(sv, cfg)
    return k.select("id_centro_custo", "orcado", "realizado",
                    rnd(F.try_divide(F.col("realizado"), nullif(F.col("orcado"), 0.0)), 6).alias("perc_consumido"),
                    rnd(F.lit(p.day) / F.lit(p.days_in_month), 6).alias("perc_mes_decorrido"))


def ideal_budget_mtd(sv: Silver, cfg: Config, ref: DataFrame | None = None) -> DataFrame:
    """M3: monthly budget x peso_do_dia of the as-of day, per (cc, cat)."""
    p = Period.of(cfg)
    keys = ["id_centro_custo", "id_categoria"]
    ref = benchmark_for(sv, cfg, True, True, [p.day]) if ref is None else ref
    w = weights(ref, True, True, [p.day]).select(*keys, F.try_element_at("__w", F.lit(p.day)).alias("peso_do_dia"))
    j = budget_month(sv, p.year, p.month, keys).join(runtime_sized(w), keys, "left")
    return j.select(*keys, money("orcado").alias("orcado"), "peso_do_dia",
                    rnd(money("orcado") * F.col("peso_do_dia"), 4).alias("orcado_ideal_mtd"))


def linear_projection(sv: Silver, cfg: Config) -> DataFrame:
    """M4: actual / day x days in month (no benchmark)."""
    p = Period.of(cfg)
    b = actual_between(sv, p.month_start, p.as_of, ["id_centro_custo", "id_categoria"])
    return b.select("id_centro_custo", "id_categoria", money("realizado").alias("realizado"),
                    rnd(money("realizado") / F.lit(p.day) * F.lit(p.days_in_month), 4).alias("projecao_linear"))


def _cc_cat_projections(sv: Silver, cfg: Config, ref: DataFrame | None, days: list[int] | None = None) -> DataFrame:
    p = Period.of(cfg)
    base = actual_between(sv, p.month_start, p.as_of, ["id_centro_custo", "id_categoria"])
    if ref is None:
        ref = benchmark_for(sv, cfg, True, True, sorted({p.day, p.days_in_month, *(days or [])}))
    return projections(base, ref, p, cfg, True, True, days)


def historical_projection(sv: Silver, cfg: Config, ref: DataFrame | None = None) -> DataFrame:
    """M5: actual / current weight x final weight."""
    b = _cc_cat_projections(sv, cfg, ref)
    return b.select("id_centro_custo", "id_categoria", money("realizado").alias("realizado"),
                    F.col("__w_now").alias("peso_atual"), F.col("__w_final").alias("peso_final"),
                    rnd("__hist", 4).alias("projecao_historica"))


def projection_path(sv: Silver, cfg: Config, ref: DataFrame | None = None) -> DataFrame:
    """M6: hybrid closing projection and its daily path from the as-of day
    to month end: actual + (final - actual) x (w_day - w_now) / (w_final - w_now)."""
    p = Period.of(cfg)
    b = _cc_cat_projections(sv, cfg, ref, list(range(p.day, p.days_in_month + 1)))
    days = b.select("*", F.explode(F.sequence(F.lit(p.day), F.lit(p.days_in_month))).alias("dia"))
    j = days.withColumn("__w_day", F.try_element_at("__w", F.col("dia")))
    frac = F.coalesce(F.try_divide(F.col("__w_day") - F.col("__w_now"),
                                   nullif(F.col("__w_final") - F.col("__w_now"), 0.0)), F.lit(0.0))
    r = money("realizado")
    return j.select("id_centro_custo", "id_categoria", "dia",
                    rnd("__final", 4).alias("projecao_final"),
                    rnd(r + (F.col("__final") - r) * frac, 4).alias("projecao_no_dia"))


def risk_matrix(sv: Silver, cfg: Config) -> DataFrame:
    """M7: risk light per cost centre."""
    c = consumption(sv, cfg)
    return c.select("id_centro_custo", "orcado", "realizado", "perc_consumido",
                    risk_light(F.col("realizado"), F.col("orcado"), cfg.risk_amber).alias("semaforo"))


def _cc_projection(sv: Silver, cfg: Config, ref: DataFrame | None) -> DataFrame:
    p = Period.of(cfg)
    ref = benchmark_for(sv, cfg, True, False, [p.day, p.days_in_month]) if ref is None else ref
    base = actual_between(sv, p.month_start, p.as_of, ["id_centro_custo"])
    pr = projections(base, ref, p, cfg, True, False)
    o = budget_month(sv, p.year, p.month, ["id_centro_custo"])
    return pr.join(o, ["id_centro_custo"], "left")


def pace(sv: Silver, cfg: Config, ref: DataFrame | None = None) -> DataFrame:
    """M8: pace status per cost centre from its hybrid projection."""
    j = _cc_projection(sv, cfg, ref)
    return j.select("id_centro_custo", money("orcado").alias("orcado"),
                    rnd("__final", 2).alias("projecao_fechamento"),
                    pace_status(F.col("__final"), money("orcado"), cfg.pace_tolerance).alias("status_ritmo"))


def forecast_vs_budget(sv: Silver, cfg: Config, ref: DataFrame | None = None) -> DataFrame:
    """Expected month-end result = hybrid projection - budget."""
    j = _cc_projection(sv, cfg, ref)
    return j.select("id_centro_custo", rnd("__final", 2).alias("projecao_fechamento"),
                    money("orcado").alias("orcado"),
                    rnd(F.col("__final") - F.coalesce(money("orcado"), F.lit(0.0)), 2).alias("resultado_previsto"))


def top_risk(sv: Silver, cfg: Config) -> DataFrame:
    """M9: top-k cost centres by budget consumption."""
    c = consumption(sv, cfg)
    return ranking.top_k(c, [F.col("perc_consumido").desc_nulls_last(), F.col("id_centro_custo")], cfg.top_k)


def top_projected_overrun(sv: Silver, cfg: Config, ref: DataFrame | None = None) -> DataFrame:
    """M9 by projection: top-k cost centres by expected overrun of the month's budget."""
    j = _cc_projection(sv, cfg, ref)
    over = rnd(F.col("__final") - F.coalesce(money("orcado"), F.lit(0.0)), 2).alias("estouro_previsto")
    j = j.select("id_centro_custo", money("orcado").alias("orcado"), rnd("__final", 2).alias("projecao_fechamento"), over)
    return ranking.top_k(j, [F.col("estouro_previsto").desc_nulls_last(), F.col("id_centro_custo")], cfg.top_k)


def top_suppliers(sv: Silver, cfg: Config) -> DataFrame:
    """M10 for suppliers: top-k by spend, year to date."""
    p = Period.of(cfg)
    a = actual_between(sv, dt.date(p.year, 1, 1), p.as_of, ["id_fornecedor"])
    top = ranking.top_k(a.select("id_fornecedor", money("realizado").alias("realizado")),
                        [F.col("realizado").desc(), F.col("id_fornecedor")], cfg.top_k)
    names = sv.dim_fornecedores.select(F.col("id_forn").alias("__fid"), "nome_forn")
    return F.broadcast(top).join(names, F.col("id_fornecedor") == F.col("__fid"), "inner") \
            .select("id_fornecedor", F.col("nome_forn").alias("fornecedor"), "realizado")       # k rows are broadcast


def top_categories(sv: Silver, cfg: Config) -> DataFrame:
    """Top-k categories by spend, month to date."""
    p = Period.of(cfg)
    a = actual_between(sv, p.month_start, p.as_of, ["id_categoria"])
    names = bounded(sv.dim_categoria.select(F.col("id_categoria").alias("__cid"), "nome_categoria"))
    a = a.join(names, F.col("id_categoria") == F.col("__cid"), "left")
    a = a.select("id_categoria", "nome_categoria", money("realizado").alias("realizado"))
    return ranking.top_k(a, [F.col("realizado").desc(), F.col("id_categoria")], cfg.top_k)


def top_suppliers_per_category(sv: Silver, cfg: Config) -> DataFrame:
    """M10 per-group variant: top-k suppliers of each category, year to date
    (salted two-phase ranking: a category with most suppliers is split)."""
    p = Period.of(cfg)
    a = actual_between(sv, dt.date(p.year, 1, 1), p.as_of, ["id_categoria", "id_fornecedor"])
    a = a.select("id_categoria", "id_fornecedor", money("realizado").alias("realizado"))
    return ranking.top_k_per_group(a, ["id_categoria"], [F.col("realizado").desc(), F.col("id_fornecedor")],
                                   cfg.top_k, salt_col="id_fornecedor")


def _yoy(cur: DataFrame, prev: DataFrame, key: str) -> DataFrame:
    c = cur.select(key, F.col("realizado").alias("__cur"))
    pr = prev.select(key, F.col("realizado").alias("__prev"))
    j = c.join(pr, [key], "full_outer")
    return j.select(key, money("__cur").alias("realizado_atual"), money("__prev").alias("realizado_anterior"),
                    money(F.coalesce(F.col("__cur"), F.lit(0)) - F.coalesce(F.col("__prev"), F.lit(0))).alias("yoy_abs"),
                    rnd(F.try_divide(F.col("__cur").cast("double"), nullif(F.col("__prev"), 0).cast("double")) - 1, 6)
                    .alias("yoy_perc"))


def top_growth(sv: Silver, cfg: Config) -> DataFrame:
    """Top-k cost centres by YoY growth (month to date vs same days last year)."""
    p = Period.of(cfg)
    cur = actual_between(sv, p.month_start, p.as_of, ["id_centro_custo"])
    prev = actual_between(sv, p.month_start_ly, p.as_of_ly, ["id_centro_custo"])
    y = _yoy(cur, prev, "id_centro_custo")
    return ranking.top_k(y, [F.col("yoy_perc").desc_nulls_last(), F.col("id_centro_custo")], cfg.top_k)


def pending_payables(sv: Silver, cfg: Config) -> DataFrame:
    """Total pending and share pending, month to date."""
    p = Period.of(cfg)
    fl = sv.entries_between(p.month_start, p.as_of)
    pend = F.sum(F.when(F.col("status_pagamento") == S.STATUS_OPEN, F.col("valor")))
    tot = F.sum("valor")
    return fl.agg(money(tot).alias("total"), money(F.coalesce(pend, F.lit(0))).alias("total_pendente"),
                  rnd(F.try_divide(F.coalesce(pend, F.lit(0)).cast("double"), tot.cast("double")), 6)
                  .alias("perc_pendente"))


def daily_cumulative(sv: Silver, cfg: Config) -> DataFrame:
    """Per day of the period: total, running total and cumulative %."""
    p = Period.of(cfg)
    fl = sv.entries_between(p.month_start, p.as_of)
    d = fl.groupBy("data_lancamento").agg(F.sum("valor").alias("__t")) \
          .withColumn("__ano", F.year("data_lancamento")).withColumn("__mes", F.month("data_lancamento"))
    month = ["__ano", "__mes"]                       # the period lies in one month: <= 31 rows
    run = F.sum("__t").over(Window.partitionBy(*month).orderBy("data_lancamento")
                            .rowsBetween(Window.unboundedPreceding, 0))
    tot = F.sum("__t").over(Window.partitionBy(*month))
    return d.select("data_lancamento", money("__t").alias("total_dia"), money(run).alias("acumulado"),
                    rnd(run.cast("double") / tot.cast("double"), 6).alias("perc_acumulado"))


def annual_kpis(sv: Silver, cfg: Config) -> DataFrame:
    """Budget YTD, actual YTD, variance and variance % as of the date."""
    p = Period.of(cfg)
    o = sv.fact_orcamento.filter((F.col("ano") == p.year) & (F.col("mes") <= p.month)) \
          .agg(F.sum("valor").alias("orcado_ytd"))
    r = sv.entries_between(dt.date(p.year, 1, 1), p.as_of) \
          .agg(F.sum("valor").alias("realizado_ytd"))
    j = with_scalars(o, r)                          # two one-row aggregates
    desvio = F.coalesce(F.col("realizado_ytd"), F.lit(0)) - F.coalesce(F.col("orcado_ytd"), F.lit(0))
    return j.select(F.lit(p.year).alias("ano"), money("orcado_ytd").alias("orcado_ytd"),
                    money("realizado_ytd").alias("realizado_ytd"), money(desvio).alias("desvio"),
                    rnd(F.try_divide(desvio.cast("double"), nullif(F.col("orcado_ytd"), 0).cast("double")), 6)
                    .alias("perc_desvio"))


def _bva(sv: Silver) -> DataFrame:
    orc = sv.fact_orcamento.groupBy("ano", "mes", "id_centro_custo", "id_categoria").agg(F.sum("valor").alias("orcado"))
    real = sv.fact_lancamentos.groupBy(F.year("data_lancamento").alias("ano"), F.month("data_lancamento").alias("mes"),
                                       "id_centro_custo", "id_categoria").agg(F.sum("valor").alias("realizado"))
    j = orc.join(real, ["ano", "mes", "id_centro_custo", "id_categoria"], "full_outer")
    return j.withColumn("desvio", F.coalesce(F.col("realizado"), F.lit(0)) - F.coalesce(F.col("orcado"), F.lit(0)))


def monthly_variance(sv: Silver) -> DataFrame:
    """Per month: budget, actual and the variance line."""
    g = _bva(sv).groupBy(F.expr("CAST(ano * 100 + mes AS INT)").alias("ano_mes")) \
                .agg(F.sum("orcado").alias("o"), F.sum("realizado").alias("r"), F.sum("desvio").alias("d"))
    return g.select("ano_mes", money("o").alias("orcado"), money("r").alias("realizado"), money("d").alias("desvio"))


MONTH_COLS = [f"m{m:02d}" for m in range(1, 13)]


def variance_matrix(sv: Silver, cfg: Config) -> DataFrame:
    """Variance per cost centre x month of the as-of year (pivot with
    the 12 months listed, so no extra pass collects pivot values)."""
    b = _bva(sv).filter(F.col("ano") == cfg.as_of.year)
    pv = b.groupBy("id_centro_custo").pivot("mes", list(range(1, 13))).agg(F.sum("desvio"))
    return pv.select("id_centro_custo", *[money(F.col(str(m))).alias(c) for m, c in zip(range(1, 13), MONTH_COLS)])


def yoy_monthly(sv: Silver, cfg: Config) -> DataFrame:
    """Actual per month, previous year vs as-of year side by side."""
    y = cfg.as_of.year
    fl = sv.entries_between(dt.date(y - 1, 1, 1), dt.date(y, 12, 31)).withColumn("ano", F.year("data_lancamento"))
    pv = fl.groupBy(F.month("data_lancamento").alias("mes")).pivot("ano", [y - 1, y]).agg(F.sum("valor"))
    return pv.select("mes", money(F.col(str(y - 1))).alias("ano_anterior"), money(F.col(str(y))).alias("ano_atual"))


def ytd_vs_last_year(sv: Silver, cfg: Config) -> DataFrame:
    """Per cost centre: YTD vs the same period last year, abs and %."""
    p = Period.of(cfg)
    cur = actual_between(sv, dt.date(p.year, 1, 1), p.as_of, ["id_centro_custo"])
    prev = actual_between(sv, dt.date(p.year - 1, 1, 1), p.as_of_ly, ["id_centro_custo"])
    return _yoy(cur, prev, "id_centro_custo")


def growth_table(sv: Silver, cfg: Config) -> DataFrame:
    """Per cost centre: YoY abs and % of the as-of month (whole months)."""
    p = Period.of(cfg)
    cur, prev = (actual_between(sv, dt.date(y, p.month, 1), dt.date(y, p.month, pycal.monthrange(y, p.month)[1]), ["id_centro_custo"])
                 .drop("qtd_lancamentos") for y in (p.year, p.year - 1))
    return _yoy(cur, prev, "id_centro_custo")


def pace_table(sv: Silver, cfg: Config, ref: DataFrame | None = None) -> DataFrame:
    """Per day of the as-of month: ideal budget MTD, actual MTD,
    historical median MTD and the closing projection path (company level)."""
    p = Period.of(cfg)
    month = list(range(1, p.days_in_month + 1))
    ref = benchmark_for(sv, cfg, False, False, month) if ref is None else ref
    o = budget_month(sv, p.year, p.month, []).select(money("orcado").alias("__orc"))
    fl = sv.entries_between(p.month_start, p.as_of)
    daily = fl.groupBy(F.dayofmonth("data_lancamento").alias("dia")).agg(F.sum("valor").alias("__t"))
    total = daily.agg(F.sum("__t").alias("realizado"))
    pr = with_scalars(projections(total, ref, p, cfg, False, False, month), o)      # one row: weights, budget, projection
    days = pr.select("*", F.lit(p.month).alias("mes"), F.explode(F.sequence(F.lit(1), F.lit(p.days_in_month))).alias("dia"))
    j = (days.join(runtime_sized(daily), ["dia"], "left").withColumn("__w_day", F.try_element_at("__w", F.col("dia")))
         .withColumn("valor_mediano_dia", F.try_element_at("__v", F.col("dia"))))
    run = F.sum(F.coalesce(F.col("__t"), F.lit(0))).over(
        Window.partitionBy("mes").orderBy("dia").rowsBetween(Window.unboundedPreceding, 0))
    r = money("realizado")
    frac = F.coalesce(F.try_divide(F.col("__w_day") - F.col("__w_now"),
                                   nullif(F.col("__w_final") - F.col("__w_now"), 0.0)), F.lit(0.0))
    return j.select(
        "dia",
        rnd(F.col("__orc") * F.col("__w_day"), 4).alias("orcado_ideal_mtd"),
        F.when(F.col("dia") <= p.day, money(run)).alias("realizado_mtd"),
        F.col("valor_mediano_dia").alias("mediana_historica_mtd"),
        F.when(F.col("dia") >= p.day, rnd(r + (F.col("__final") - r) * frac, 4)).alias("projecao"),
    )
