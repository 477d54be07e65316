"""Gold views (G1-G9) composed from the operators.

Column names are the reference's, lower-cased and without blanks/accents.
Money leaves as double (exact decimal sums converted once); ratios are
rounded to 6 digits.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight import schemas as S
from ledgerlight.functions.dates import month_end, year_month
from ledgerlight.functions.safe import money, nullif, rnd
from ledgerlight.operators import benchmark, median_state, periods, steps
from ledgerlight.operators.joins import bounded, fits, runtime_sized
from ledgerlight.operators.running import BLOCK, running_sum
from ledgerlight.plans.config import Config
from ledgerlight.plans.silver import BENCHMARK_VALUES, MEMBER, Silver, share_of_month


def _dim(df: DataFrame, **names: str) -> DataFrame:
    """A dimension with its columns renamed (fresh attributes: the same
    dimension also feeds the silver steps) and broadcast if proven small."""
    if not names:
        return bounded(df)
    renamed = df.select(*[F.col(src).alias(dst) for src, dst in names.items()])
    return F.broadcast(renamed) if fits(df) else renamed


def cc_dim(sv: Silver) -> DataFrame:
    return _dim(sv.dim_centro_custo, id_cc="cc_id", nome_cc="cc_nome")


def cat_dim(sv: Silver) -> DataFrame:
    return _dim(sv.dim_categoria, id_categoria="cat_id", nome_categoria="cat_nome")


def forn_dim(sv: Silver) -> DataFrame:
    return _dim(sv.dim_fornecedores, id_forn="forn_id", nome_forn="forn_nome")


def camp_dim(sv: Silver) -> DataFrame:
    return _dim(sv.dim_camp_marketing, id_camp="camp_id", nome_campanha="camp_nome")


# ------------------------------------------------------------------ G1
def budget_monthly(sv: Silver) -> DataFrame:
    """A1 + J1: SUM(valor) by year, month, cost centre, category, status."""
    fo = sv.fact_orcamento
    j = (fo.join(cc_dim(sv), F.col("id_centro_custo") == F.col("cc_id"), "left")
           .join(cat_dim(sv), F.col("id_categoria") == F.col("cat_id"), "left"))
    return j.groupBy("ano", "mes", F.col("cc_id").alias("id_centro_de_custo"),
                     F.col("cc_nome").alias("centro_de_custo"), "id_categoria",
                     F.col("cat_nome").alias("categoria"), "status_dado") \
            .agg(F.sum("valor").alias("orcado"))


def gold_orcamento(sv: Silver) -> DataFrame:
    b = periods.with_month_total(budget_monthly(sv), "orcado", ["ano", "mes", "status_dado"], "__mes")
    o = F.col("orcado")
    member = ["ano", "id_centro_de_custo", "id_categoria", "status_dado"]
    mean = periods.group_mean(o, member, ignore_zero=True)
    return b.select(
        month_end("ano", "mes").alias("data_de_orcamento"),
        year_month("ano", "mes").alias("ano_mes"),
        "ano", "mes", "id_centro_de_custo", "centro_de_custo", "id_categoria", "categoria",
        money(nullif(o, 0)).alias("orcado_mensal"),
        money(periods.cumulative(o, member, ["mes"])).alias("orcado_ytd"),
        periods.share(o, ["ano", "id_centro_de_custo", "mes", "status_dado"], "__mes", guard_numerator=True).alias("peso_centro_custo"),
        periods.share(o, ["ano", "id_categoria", "mes", "status_dado"], "__mes", guard_numerator=True).alias("peso_categoria"),
        rnd(mean, 6).alias("media_mensal"),
        periods.atypical_two_way(nullif(o, 0), mean).alias("flag_valor_atipico_orcamento"),
        "status_dado",
    )


# ------------------------------------------------------------------ G2
def actual_monthly(sv: Silver) -> DataFrame:
    """A2 + J1: SUM(valor) by year, month, cost centre, category + wildcard flag."""
    t = sv.monthly_totals
    j = (t.join(cc_dim(sv), F.col("id_centro_custo") == F.col("cc_id"), "left")
          .join(cat_dim(sv), F.col("id_categoria") == F.col("cat_id"), "left"))
    return j.select("ano", "mes", F.col("id_centro_custo").alias("id_centro_de_custo"), F.col("cc_nome").alias("centro_de_custo"),
                    F.col("cat_id").alias("id_categoria"), F.col("cat_nome").alias("categoria"), "realizado") \
            .withColumn("ano_mes", year_month("ano", "mes")) \
            .withColumn("flag_centro_custo_coringa",
                        F.when(F.col("id_centro_de_custo") == S.DEFAULT_MEMBER_ID, F.lit(S.FLAG_YES))
                        .otherwise(F.lit(S.FLAG_NO)))


def on_months(base: DataFrame) -> DataFrame:
    """Monthly rows on the months of all years that they cover
    (``cal_ano``, ``cal_mes``); a month without rows keeps one all-NULL row.

    The years come from the rows themselves, so none can fall outside."""
    years = base.agg(F.make_date(F.min("ano"), F.lit(1), F.lit(1)).alias("inicio"),
                     F.make_date(F.max("ano"), F.lit(12), F.lit(1)).alias("fim"))
    months = (years.select(F.explode(F.sequence("inicio", "fim", F.expr("INTERVAL 1 MONTH"))).alias("__m"))
              .select(F.year("__m").alias("cal_ano"), F.month("__m").alias("cal_mes")))
    # written as base RIGHT JOIN months so that the aggregated base can be the
    # build side when adaptive execution finds it small
    return runtime_sized(base).join(months, (F.col("ano") == F.col("cal_ano")) & (F.col("mes") == F.col("cal_mes")), "right")


def gold_realizado(sv: Silver, lag_mode: str = "rows") -> DataFrame:
    """Monthly actuals on a month scaffold (J2), YTD, MoM/YoY, mean,
    shares and atypical flag. ``lag_mode``: "rows" compares with the member's
    previous row, "calendar" with the calendar month before."""
    j = periods.with_month_total(on_months(actual_monthly(sv)), "realizado", ["ano", "mes"], "__mes")
    r = F.col("realizado")
    member = ["id_centro_de_custo", "id_categoria"]
    year_member = ["ano", *member]
    if lag_mode == "rows":
        prev1 = periods.lagged(r, member, ["cal_ano", "cal_mes"], 1)
        prev12 = periods.lagged(r, member, ["cal_ano", "cal_mes"], 12)
    else:
        index = F.col("cal_ano") * 12 + F.col("cal_mes")
        prev1 = periods.calendar_lagged(r, member, index, 1)
        prev12 = periods.calendar_lagged(r, member, index, 12)
    j = j.withColumn("__p1", prev1).withColumn("__p12", prev12)
    mean_nz = periods.group_mean(r, year_member, ignore_zero=True)
    return j.select(
        month_end("ano", "mes").alias("data_realizacao"),
        "ano", "mes", "ano_mes", "id_centro_de_custo", "centro_de_custo", "id_categoria", "categoria",
        money(r).alias("realizado"),
        money(periods.cumulative(r, year_member, ["ano", "mes"])).alias("realizado_ytd"),
        money(periods.change_abs(r, F.col("__p1"))).alias("mom_abs"),
        periods.change_pct(r, F.col("__p1")).alias("mom_perc"),
        money(periods.change_abs(r, F.col("__p12"))).alias("yoy_abs"),
        periods.change_pct(r, F.col("__p12")).alias("yoy_perc"),
        rnd(periods.group_mean(r, year_member), 6).alias("media_mensal"),
        periods.share(r, ["id_centro_de_custo", "ano", "mes"], "__mes").alias("peso_centro_custo"),
        periods.share(r, ["id_categoria", "ano", "mes"], "__mes").alias("peso_categoria"),
        periods.atypical_three_way(r, mean_nz).alias("flag_valor_atipico_realizado"),
        "flag_centro_custo_coringa",
    )


# ------------------------------------------------------------------ G3
def ledger_enriched(sv: Silver, fact: DataFrame | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """J1 x4: each entry with its cost centre, category, supplier and campaign.
    ``fact`` replaces the silver ledger (e.g. with running totals added);
    ``carry`` lists its extra columns to keep."""
    fl = sv.fact_lancamentos if fact is None else fact
    j = (fl.join(cc_dim(sv), F.col("id_centro_custo") == F.col("cc_id"), "left")
           .join(cat_dim(sv), F.col("id_categoria") == F.col("cat_id"), "left")
           .join(forn_dim(sv), F.col("id_fornecedor") == F.col("forn_id"), "left")
           .join(camp_dim(sv), F.col("id_campanha") == F.col("camp_id"), "left"))
    c = F.col
    return j.select(
        "id_lancamento", "data_lancamento",
        c("cc_id").alias("id_centro_de_custo"), c("cc_nome").alias("centro_de_custo"),
        c("cat_id").alias("id_categoria"), c("cat_nome").alias("categoria"),
        c("forn_id").alias("id_fornecedor"), c("forn_nome").alias("fornecedor"),
        c("camp_id").alias("id_campanha"), c("camp_nome").alias("campanha_de_marketing"),
        "valor", "valor_original",
        F.replace(c("status_pagamento"), F.lit(S.STATUS_OPEN), F.lit(S.STATUS_PENDING)).alias("status_pagamento"),
        *carry,
    )


LEDGER_COLUMNS = ["id_lancamento", "data_lancamento", "id_centro_de_custo", "centro_de_custo",
                  "id_categoria", "categoria", "id_fornecedor", "fornecedor", "id_campanha",
                  "campanha_de_marketing", "valor", "valor_original"]


MTD_COLUMNS = ("gasto_mtd", "gasto_mtd_cc_cat")


def with_ledger_mtd(fl: DataFrame, which: tuple[str, ...] = MTD_COLUMNS, block: int = BLOCK) -> DataFrame:
    """W12 + W13: running month-to-date per entry of the (narrow) ledger
    fact, before any name is joined, so keys and values only are shuffled."""
    e = fl.withColumn("__ano", F.year("data_lancamento")).withColumn("__mes", F.month("data_lancamento"))
    coarse = ["__ano", "__mes", "id_centro_custo", "id_categoria"]
    groups = {"gasto_mtd": [*coarse, "id_fornecedor", "id_campanha"], "gasto_mtd_cc_cat": coarse}
    for name in which:
        e = running_sum(e, groups[name], "data_lancamento", "id_lancamento", "valor", name, block)
    return e.drop("__ano", "__mes")


def gold_lancamentos(sv: Silver, block: int = BLOCK) -> DataFrame:
    """Entry-level ledger with two MTD running totals (``block``: ids per block of a hot day)."""
    e = ledger_enriched(sv, with_ledger_mtd(sv.fact_lancamentos, block=block), MTD_COLUMNS)
    return e.select(*[F.col(c) for c in LEDGER_COLUMNS[:10]], money("valor").alias("valor"),
                    money("valor_original").alias("valor_original"),
                    money("gasto_mtd").alias("gasto_mtd"), money("gasto_mtd_cc_cat").alias("gasto_mtd_cc_cat"),
                    "status_pagamento")


# ------------------------------------------------------------------ G4
def daily_grid(sv: Silver, end: dt.date | None = None) -> DataFrame:
    """J3 + J4: (day x cost centre x category) grid over the calendar of the
    entries (up to ``end``) with the day totals, zero where nothing was
    booked, and the running and whole totals of the month. Days are spelled
    out of the member's months (``operators.steps``)."""
    span = sv.calendar_span
    if end:
        span = span.select("inicio", F.least(F.col("fim"), F.lit(end)).alias("fim"))
    return steps.spelled(sv.member_months, sv.members, span, MEMBER, "data_lancamento")


def mtd_history(sv: Silver, cfg: Config, cut: bool = True) -> DataFrame:
    """Dense (day x cost centre x category) grid with day totals, MTD, month
    total and cumulative share. ``cut`` keeps the days before the history cut."""
    h = daily_grid(sv, cfg.history_cut - dt.timedelta(days=1) if cut else None)
    return h.withColumn("perc_gasto_mes", share_of_month())


def gold_referencia_mtd(sv: Silver, cfg: Config, sets: list[list[str]] | None = None, days: list[int] | None = None,
                        bits: int = benchmark.RANGE_BITS) -> DataFrame:
    """Per day of month, the median cumulative share (peso_do_dia) and
    median MTD value at four grains, -999 = all. ``sets`` and ``days`` build
    only the grains and days of the month that a measure needs. The grid is
    counted, not made: months without bookings are one row per member. Grains
    that put members together read the kept counts of their months
    (``operators.median_state``); with other ``bits`` all are counted anew."""
    sets = benchmark._all_sets(MEMBER) if sets is None else [list(st) for st in sets]
    kept = [st for st in sets if bits == benchmark.RANGE_BITS and len(st) < len(MEMBER)]
    anew = [st for st in sets if st not in kept]
    history = steps.before(sv.month_steps, cfg.history_cut).withColumn("perc_gasto_mes", share_of_month())
    found = []
    if kept:
        cells = median_state.all_cells(sv.members, sv.calendar_span, MEMBER, kept, cfg.history_cut, days)
        found.append(median_state.medians(median_state.before(sv.median_ranges, cfg.history_cut), history, cells, MEMBER, BENCHMARK_VALUES,
                                          "valor_mediano_dia", kept, days))
    if anew:
        cells = steps.cells(sv.members, sv.calendar_span, MEMBER, cfg.history_cut)
        h = steps.weighted_days(history.drop("perc_gasto_mes"), cells, MEMBER, days).withColumn("perc_gasto_mes", share_of_month())
        found.append(benchmark.multi_grain_median(h, "dia", MEMBER, BENCHMARK_VALUES, sets=anew, bits=bits, weight="celulas"))
    m = reduce(DataFrame.unionByName, found)
    return m.select("dia", "id_centro_custo", "id_categoria",
                    rnd("peso_do_dia", 6).alias("peso_do_dia"),
                    rnd("valor_mediano_dia", 4).alias("valor_mediano_dia"))


# ------------------------------------------------------------------ G5
def gold_lancamentos_diarios(sv: Silver) -> DataFrame:
    """Dense (day x cost centre x category x status) grid up to the last
    entry date with the MTD per status."""
    fl = sv.fact_lancamentos
    j = (fl.join(cc_dim(sv), F.col("id_centro_custo") == F.col("cc_id"), "left")
           .join(cat_dim(sv), F.col("id_categoria") == F.col("cat_id"), "left"))
    base = j.groupBy("data_lancamento", F.col("cc_id").alias("id_centro_custo"),
                     F.col("cat_id").alias("id_categoria"),
                     F.replace(F.col("status_pagamento"), F.lit(S.STATUS_OPEN), F.lit(S.STATUS_PENDING))
                     .alias("status_pagamento")) \
            .agg(F.sum("valor").alias("valor_dia"))
    keys = ["id_centro_custo", "id_categoria", "status_pagamento"]
    months = steps.member_months(base, "data_lancamento", keys, "valor_dia")
    # from the first day of the first year up to the last entry date, in the same plan
    span = base.agg(F.trunc(F.min("data_lancamento"), "year").alias("inicio"), F.max("data_lancamento").alias("fim"))
    d = steps.spelled(months, months.select(*keys).distinct(), span, keys, "data_lancamento")
    return d.select("data_lancamento", "ano", "mes", "dia", "id_centro_custo",
                    "id_categoria", "status_pagamento", money("gasto_mtd").alias("gasto_mtd_agregado"))


# ------------------------------------------------------------------ G6
def gold_lancamentos_consolidados_dia(sv: Silver) -> DataFrame:
    """Daily totals per cost centre, category, supplier, status and the
    share of the month (month total via partial aggregate + join).

    Ids are grouped and names joined to the groups: the load gives every entry
    one parent of each kind. The month totals are taken over the entries, a row per
    month and task, so that the groups, nearly as many as entries, are made once."""
    keys = ["data_lancamento", "id_centro_de_custo", "centro_de_custo", "id_categoria", "categoria",
            "id_fornecedor", "fornecedor", "status_pagamento"]
    c, month = F.col, ["__ano", "__mes"]
    status = F.replace(c("status_pagamento"), F.lit(S.STATUS_OPEN), F.lit(S.STATUS_PENDING)).alias("status_pagamento")
    e = sv.fact_lancamentos.withColumn("__ano", F.year("data_lancamento")).withColumn("__mes", F.month("data_lancamento"))
    b = e.select("data_lancamento", "id_centro_custo", c("id_categoria").alias("__cat"), c("id_fornecedor").alias("__forn"), status, *month, "valor") \
         .groupBy("data_lancamento", "id_centro_custo", "__cat", "__forn", "status_pagamento", *month).agg(F.sum("valor").alias("total_do_dia"))
    b = (b.join(cc_dim(sv), c("id_centro_custo") == c("cc_id"), "left")
          .join(cat_dim(sv), c("__cat") == c("cat_id"), "left")
          .join(forn_dim(sv), c("__forn") == c("forn_id"), "left"))
    b = b.select("data_lancamento", c("cc_id").alias("id_centro_de_custo"), c("cc_nome").alias("centro_de_custo"),
                 c("cat_id").alias("id_categoria"), c("cat_nome").alias("categoria"),
                 c("forn_id").alias("id_fornecedor"), c("forn_nome").alias("fornecedor"), "status_pagamento", "total_do_dia", *month)
    s = periods.share_of_total(b, "total_do_dia", month, "participacao_no_mes", totals=periods.month_totals(e, "valor", month, "__tot"))
    return s.select(*keys[:7], money("total_do_dia").alias("total_do_dia"), "status_pagamento",
                    "participacao_no_mes")


# ------------------------------------------------------------------ G7
def mtd_report(sv: Silver, cfg: Config) -> DataFrame:
    """For one cost centre name, a date range and a status: per
    day, SUM(valor) and SUM(gasto_mtd_cc_cat).

    The running total partitions by (year, month, cost centre, category)
    and only looks back, so entries can be restricted BEFORE it to the
    named cost centres and to [first day of start month, end]: exact, and
    the window runs on that slice instead of the whole ledger.
    """
    start_month = cfg.report_start.replace(day=1)
    same_name = F.upper(F.rtrim("nome_cc")) == cfg.report_cost_centre.rstrip().upper()   # CI collation
    ids = sv.dim_centro_custo.filter(same_name) \
            .select(F.col("id_cc").alias("rep_cc"))
    fl = sv.entries_between(start_month, cfg.report_end)
    fl = fl.join(bounded(ids), F.col("id_centro_custo") == F.col("rep_cc"), "left_semi")
    e = ledger_enriched(sv, with_ledger_mtd(fl, MTD_COLUMNS[1:]), MTD_COLUMNS[1:])
    e = e.filter((F.upper(F.rtrim("centro_de_custo")) == cfg.report_cost_centre.rstrip().upper())
                 & F.col("data_lancamento").between(F.lit(cfg.report_start), F.lit(cfg.report_end))
                 & (F.col("status_pagamento") == cfg.report_status))
    return (e.groupBy(F.dayofmonth("data_lancamento").alias("dia"), "centro_de_custo")
             .agg(money(F.sum("valor")).alias("valor"),
                  money(F.sum("gasto_mtd_cc_cat")).alias("gastos_mtd_cc_cat"))
             .orderBy("dia"))


# ------------------------------------------------------------------ G8
def gold_mensal(sv: Silver) -> DataFrame:
    """Budget vs actual per (year, month, cost centre, category), full
    outer so spend without budget and budget without spend both stay."""
    orc = sv.fact_orcamento.groupBy("ano", "mes", "id_centro_custo", "id_categoria") \
                           .agg(F.sum("valor").alias("orcado"))
    real = sv.monthly_totals
    keys = ["ano", "mes", "id_centro_custo", "id_categoria"]
    j = orc.join(real, keys, "full_outer")
    cc, cat = _dim(sv.dim_centro_custo), _dim(sv.dim_categoria)
    j = (j.join(cc, j.id_centro_custo == cc.id_cc, "left")
          .join(cat.select(F.col("id_categoria").alias("__cat_id"), "nome_categoria"),
                j.id_categoria == F.col("__cat_id"), "left"))
    o, r = F.col("orcado"), F.col("realizado")
    desvio = F.coalesce(r, F.lit(0)) - F.coalesce(o, F.lit(0))
    j = periods.with_month_total(j.withColumn("desvio", desvio), F.coalesce(r, F.lit(0)), ["ano", "mes"], "__mes")
    ym = ["ano", "id_centro_custo", "id_categoria"]
    return j.select(
        month_end("ano", "mes").alias("data_referencia"), year_month("ano", "mes").alias("ano_mes"),
        "ano", "mes", F.col("id_centro_custo").alias("id_centro_de_custo"), F.col("nome_cc").alias("centro_de_custo"),
        "id_categoria", F.col("nome_categoria").alias("categoria"),
        money(o).alias("orcado"), money(r).alias("realizado"), money("desvio").alias("desvio"),
        rnd(F.try_divide(r.cast("double"), nullif(o, 0).cast("double")), 6).alias("perc_atingimento"),
        rnd(F.try_divide(F.col("desvio").cast("double"), nullif(o, 0).cast("double")), 6).alias("percentual_desvio"),
        F.when(o.isNotNull(), F.lit(S.FLAG_YES)).otherwise(F.lit(S.FLAG_NO)).alias("flag_houve_orcamento"),
        periods.share(F.coalesce(r, F.lit(0)), ["ano", "mes", "id_centro_custo"], "__mes").alias("peso_centro_custo"),
        periods.share(F.coalesce(r, F.lit(0)), ["ano", "mes", "id_categoria"], "__mes").alias("peso_categoria"),
        money(periods.cumulative(F.coalesce(o, F.lit(0)), ym, ["mes"])).alias("orcado_ytd"),
        money(periods.cumulative(F.coalesce(r, F.lit(0)), ym, ["mes"])).alias("realizado_ytd"),
        money(periods.cumulative(F.col("desvio"), ym, ["mes"])).alias("desvio_ytd"),
    )


# ------------------------------------------------------------------ G9
def gold_lancamentos_diario(sv: Silver) -> DataFrame:
    """Daily-grain ledger (day x cost centre x category x supplier x
    campaign) with the MTD over the daily totals and the wildcard flag."""
    fl = sv.fact_lancamentos
    keys = ["data_lancamento", "id_centro_custo", "id_categoria", "id_fornecedor", "id_campanha"]
    d = fl.groupBy(*keys).agg(F.sum("valor").alias("total_do_dia")) \
          .withColumn("ano", F.year("data_lancamento")).withColumn("mes", F.month("data_lancamento")) \
          .withColumn("dia", F.dayofmonth("data_lancamento"))
    part = ["ano", "mes", "id_centro_custo", "id_categoria", "id_fornecedor", "id_campanha"]
    d = d.withColumn("gasto_mtd", periods.cumulative("total_do_dia", part, ["data_lancamento"]))
    cc, cat = _dim(sv.dim_centro_custo), _dim(sv.dim_categoria)
    forn, camp = _dim(sv.dim_fornecedores), _dim(sv.dim_camp_marketing)
    j = (d.join(cc, d.id_centro_custo == cc.id_cc, "left")
          .join(cat.select(F.col("id_categoria").alias("__cat_id"), "nome_categoria"),
                d.id_categoria == F.col("__cat_id"), "left")
          .join(forn, d.id_fornecedor == forn.id_forn, "left")
          .join(camp, d.id_campanha == camp.id_camp, "left"))
    return j.select(
        "ano", "mes", "dia", "data_lancamento",
        F.col("id_cc").alias("id_centro_de_custo"), F.col("nome_cc").alias("centro_de_custo"),
        F.col("__cat_id").alias("id_categoria"), F.col("nome_categoria").alias("categoria"),
        F.col("id_forn").alias("id_fornecedor"), F.col("nome_forn").alias("fornecedor"),
        F.col("id_camp").alias("id_campanha"), F.col("nome_campanha").alias("campanha_de_marketing"),
        money("total_do_dia").alias("total_do_dia"), money("gasto_mtd").alias("gasto_mtd"),
        F.when(F.col("id_centro_custo") == S.DEFAULT_MEMBER_ID, F.lit(S.FLAG_YES))
         .otherwise(F.lit(S.FLAG_NO)).alias("flag_centro_custo_coringa"),
    )
