"""Registered dashboard measures M1-M21 (as-of date of ``TESTDATA``)."""

from __future__ import annotations

from ledgerlight.plans import measures
from ledgerlight.plans.config import TESTDATA as CFG
from ledgerlight.plans.oracle_sql import d, q
from ledgerlight.plans.queries_gold import REF_CTE
from ledgerlight.plans.registry import register, silver

P = measures.Period.of(CFG)
A, MS, D, DIM, Y, M = d(P.as_of), d(P.month_start), P.day, P.days_in_month, P.year, P.month
A_LY, MS_LY = d(P.as_of_ly), d(P.month_start_ly)
LW, HW = f"CAST({CFG.linear_weight} AS DOUBLE)", f"CAST({CFG.historical_weight} AS DOUBLE)"
K = CFG.top_k

BASE = f"""
, m_act_cc AS (SELECT id_centro_custo, SUM(valor) AS realizado, COUNT(*) AS qtd_lancamentos FROM fact_lancamentos
               WHERE data_lancamento BETWEEN {MS} AND {A} GROUP BY 1),
m_orc_cc AS (SELECT id_centro_custo, SUM(valor) AS orcado FROM fact_orcamento WHERE ano = {Y} AND mes = {M} GROUP BY 1),
m1 AS (SELECT COALESCE(o.id_centro_custo, r.id_centro_custo) AS id_centro_custo, CAST(o.orcado AS DOUBLE) AS orcado,
              CAST(r.realizado AS DOUBLE) AS realizado, COALESCE(r.qtd_lancamentos, 0) AS qtd_lancamentos
       FROM m_orc_cc o FULL OUTER JOIN m_act_cc r ON o.id_centro_custo = r.id_centro_custo),
m2 AS (SELECT id_centro_custo, orcado, realizado, round(realizado / NULLIF(orcado, 0.0), 6) AS perc_consumido,
              round({D} / {DIM}, 6) AS perc_mes_decorrido FROM m1)
"""

REF = REF_CTE + """
, ref_cc_cat AS (SELECT * FROM ref WHERE id_centro_custo <> -999 AND id_categoria <> -999),
ref_cc AS (SELECT * FROM ref WHERE id_centro_custo <> -999 AND id_categoria = -999),
ref_all AS (SELECT * FROM ref WHERE id_centro_custo = -999 AND id_categoria = -999)
"""

PROJ_CC_CAT = REF + f"""
, m_act_cc_cat AS (SELECT id_centro_custo, id_categoria, SUM(valor) AS realizado FROM fact_lancamentos
                   WHERE data_lancamento BETWEEN {MS} AND {A} GROUP BY 1, 2),
proj AS (
  SELECT a.*, wn.peso_do_dia AS w_now, wf.peso_do_dia AS w_final,
         CAST(a.realizado AS DOUBLE) / {D} * {DIM} AS linear,
         CAST(a.realizado AS DOUBLE) / NULLIF(wn.peso_do_dia, 0.0) * wf.peso_do_dia AS hist
  FROM m_act_cc_cat a
  LEFT JOIN ref_cc_cat wn ON wn.dia = {D} AND wn.id_centro_custo = a.id_centro_custo AND wn.id_categoria = a.id_categoria
  LEFT JOIN ref_cc_cat wf ON wf.dia = {DIM} AND wf.id_centro_custo = a.id_centro_custo AND wf.id_categoria = a.id_categoria),
proj2 AS (SELECT *, {LW} * linear + {HW} * COALESCE(hist, linear) AS final FROM proj)
"""

PROJ_CC = REF + BASE + f"""
, proj_cc AS (
  SELECT a.id_centro_custo, a.realizado,
         CAST(a.realizado AS DOUBLE) / {D} * {DIM} AS linear,
         CAST(a.realizado AS DOUBLE) / NULLIF(wn.peso_do_dia, 0.0) * wf.peso_do_dia AS hist
  FROM m_act_cc a
  LEFT JOIN ref_cc wn ON wn.dia = {D} AND wn.id_centro_custo = a.id_centro_custo
  LEFT JOIN ref_cc wf ON wf.dia = {DIM} AND wf.id_centro_custo = a.id_centro_custo),
proj_cc2 AS (SELECT p.*, {LW} * linear + {HW} * COALESCE(hist, linear) AS final, CAST(o.orcado AS DOUBLE) AS orcado
             FROM proj_cc p LEFT JOIN m_orc_cc o ON o.id_centro_custo = p.id_centro_custo)
"""


@register("m1", q(BASE + "SELECT * FROM m1"))
def m1(spark, sf_dir):
    return measures.kpis_by_cost_centre(silver(spark, sf_dir), CFG)


@register("m1t", q(f"""
, o AS (SELECT SUM(valor) AS orcado FROM fact_orcamento WHERE ano = {Y} AND mes = {M}),
r AS (
  SELECT SUM(valor) FILTER (WHERE data_lancamento BETWEEN {MS} AND {A}) AS mtd,
         SUM(valor) FILTER (WHERE date_trunc('month', data_lancamento) = {MS}) AS mes,
         SUM(valor) FILTER (WHERE date_trunc('month', data_lancamento) = {MS} - INTERVAL 1 MONTH) AS antes,
         SUM(valor) FILTER (WHERE data_lancamento BETWEEN {MS_LY} AND {A_LY}) AS ly,
         SUM(valor) FILTER (WHERE data_lancamento BETWEEN DATE '{Y}-01-01' AND {A}) AS ytd,
         SUM(valor) FILTER (WHERE data_lancamento BETWEEN DATE '{Y - 1}-01-01' AND {A_LY}) AS ytd_ly
  FROM fact_lancamentos)
SELECT CAST(orcado AS DOUBLE) AS orcado, CAST(mtd AS DOUBLE) AS realizado, CAST(mes AS DOUBLE) AS realizado_mes,
       CAST(coalesce(mtd, 0) - coalesce(orcado, 0) AS DOUBLE) AS desvio, CAST(antes AS DOUBLE) AS realizado_mes_anterior,
       round(CAST(mes AS DOUBLE) / nullif(CAST(antes AS DOUBLE), 0) - 1, 6) AS mom_perc, CAST(ly AS DOUBLE) AS realizado_ano_anterior,
       round(CAST(mtd AS DOUBLE) / nullif(CAST(ly AS DOUBLE), 0) - 1, 6) AS yoy_perc, CAST(ytd AS DOUBLE) AS realizado_ytd,
       CAST(ytd_ly AS DOUBLE) AS realizado_ytd_ano_anterior, round(CAST(ytd AS DOUBLE) / nullif(CAST(ytd_ly AS DOUBLE), 0) - 1, 6) AS ytd_perc
FROM o, r
"""))
def m1t(spark, sf_dir):
    """The company's cards."""
    return measures.company_cards(silver(spark, sf_dir), CFG)


@register("m2", q(BASE + "SELECT * FROM m2"))
def m2(spark, sf_dir):
    return measures.consumption(silver(spark, sf_dir), CFG)


@register("m3", q(REF + f"""
, o AS (SELECT id_centro_custo, id_categoria, SUM(valor) AS orcado FROM fact_orcamento WHERE ano = {Y} AND mes = {M} GROUP BY 1, 2)
SELECT o.id_centro_custo, o.id_categoria, CAST(o.orcado AS DOUBLE) AS orcado, w.peso_do_dia,
       round(CAST(o.orcado AS DOUBLE) * w.peso_do_dia, 4) AS orcado_ideal_mtd
FROM o LEFT JOIN ref_cc_cat w ON w.dia = {D} AND w.id_centro_custo = o.id_centro_custo AND w.id_categoria = o.id_categoria
"""))
def m3(spark, sf_dir):
    return measures.ideal_budget_mtd(silver(spark, sf_dir), CFG)


@register("m4", q(PROJ_CC_CAT + """
SELECT id_centro_custo, id_categoria, CAST(realizado AS DOUBLE) AS realizado, round(linear, 4) AS projecao_linear FROM proj2
"""))
def m4(spark, sf_dir):
    return measures.linear_projection(silver(spark, sf_dir), CFG)


@register("m5", q(PROJ_CC_CAT + """
SELECT id_centro_custo, id_categoria, CAST(realizado AS DOUBLE) AS realizado, w_now AS peso_atual, w_final AS peso_final,
       round(hist, 4) AS projecao_historica FROM proj2
"""))
def m5(spark, sf_dir):
    return measures.historical_projection(silver(spark, sf_dir), CFG)


@register("m6", q(PROJ_CC_CAT + f"""
, proj_days AS (SELECT *, CAST(unnest(range({D}, {DIM} + 1)) AS INTEGER) AS dia FROM proj2)
SELECT p.id_centro_custo, p.id_categoria, p.dia, round(p.final, 4) AS projecao_final,
       round(CAST(p.realizado AS DOUBLE) + (p.final - CAST(p.realizado AS DOUBLE))
             * COALESCE((wd.peso_do_dia - p.w_now) / NULLIF(p.w_final - p.w_now, 0.0), 0.0), 4) AS projecao_no_dia
FROM proj_days p
LEFT JOIN ref_cc_cat wd ON wd.dia = p.dia AND wd.id_centro_custo = p.id_centro_custo AND wd.id_categoria = p.id_categoria
"""))
def m6(spark, sf_dir):
    return measures.projection_path(silver(spark, sf_dir), CFG)


@register("m7", q(BASE + f"""
SELECT id_centro_custo, orcado, realizado, perc_consumido,
       CASE WHEN COALESCE(realizado, 0.0) > COALESCE(orcado, 0.0) THEN 'Vermelho'
            WHEN COALESCE(realizado, 0.0) >= orcado * CAST({CFG.risk_amber} AS DOUBLE) THEN 'Laranja'
            ELSE 'Verde' END AS semaforo
FROM m2
"""))
def m7(spark, sf_dir):
    return measures.risk_matrix(silver(spark, sf_dir), CFG)


_UP, _DOWN = 1 + CFG.pace_tolerance, 1 - CFG.pace_tolerance


@register("m8", q(PROJ_CC + f"""
SELECT id_centro_custo, orcado, round(final, 2) AS projecao_fechamento,
       CASE WHEN final > COALESCE(orcado, 0.0) * CAST({_UP!r} AS DOUBLE) THEN 'Tende a Estourar'
            WHEN final < COALESCE(orcado, 0.0) * CAST({_DOWN!r} AS DOUBLE) THEN 'Abaixo do Ritmo'
            ELSE 'Dentro do Esperado' END AS status_ritmo
FROM proj_cc2
"""))
def m8(spark, sf_dir):
    return measures.pace(silver(spark, sf_dir), CFG)


@register("m9", q(BASE + f"SELECT * FROM m2 ORDER BY perc_consumido DESC NULLS LAST, id_centro_custo LIMIT {K}"))
def m9(spark, sf_dir):
    return measures.top_risk(silver(spark, sf_dir), CFG)


@register("m9p", q(PROJ_CC + f"""
SELECT id_centro_custo, orcado, round(final, 2) AS projecao_fechamento, round(final - COALESCE(orcado, 0.0), 2) AS estouro_previsto
FROM proj_cc2 ORDER BY estouro_previsto DESC NULLS LAST, id_centro_custo LIMIT {K}
"""))
def m9p(spark, sf_dir):
    """M9 by projected overrun."""
    return measures.top_projected_overrun(silver(spark, sf_dir), CFG)


@register("m10f", q(f"""
SELECT s.id_forn AS id_fornecedor, s.nome_forn AS fornecedor, CAST(SUM(e.valor) AS DOUBLE) AS realizado
FROM fact_lancamentos e JOIN dim_fornecedores s ON s.id_forn = e.id_fornecedor
WHERE e.data_lancamento BETWEEN DATE '{Y}-01-01' AND {A} GROUP BY ALL ORDER BY realizado DESC, id_fornecedor LIMIT {K}
"""))
def m10f(spark, sf_dir):
    """M10 for suppliers over the year to date."""
    return measures.top_suppliers(silver(spark, sf_dir), CFG)


@register("m10", q(f"""
, a AS (SELECT id_categoria, SUM(valor) AS r FROM fact_lancamentos WHERE data_lancamento BETWEEN {MS} AND {A} GROUP BY 1)
SELECT a.id_categoria, c.nome_categoria, CAST(a.r AS DOUBLE) AS realizado
FROM a LEFT JOIN dim_categoria c ON c.id_categoria = a.id_categoria
ORDER BY realizado DESC, a.id_categoria LIMIT {K}
"""))
def m10(spark, sf_dir):
    return measures.top_categories(silver(spark, sf_dir), CFG)


@register("m10s", q(f"""
SELECT * FROM (
  SELECT id_categoria, id_fornecedor, CAST(SUM(valor) AS DOUBLE) AS realizado,
         CAST(row_number() OVER (PARTITION BY id_categoria ORDER BY SUM(valor) DESC, id_fornecedor) AS INTEGER) AS posicao
  FROM fact_lancamentos WHERE data_lancamento BETWEEN DATE '{Y}-01-01' AND {A} GROUP BY 1, 2) t
WHERE posicao <= {K}
"""))
def m10s(spark, sf_dir):
    return measures.top_suppliers_per_category(silver(spark, sf_dir), CFG)


def _yoy_sql(cur_where: str, prev_where: str) -> str:
    return f"""
, cur AS (SELECT id_centro_custo, SUM(valor) AS r FROM fact_lancamentos WHERE {cur_where} GROUP BY 1),
prev AS (SELECT id_centro_custo, SUM(valor) AS r FROM fact_lancamentos WHERE {prev_where} GROUP BY 1),
yoy AS (
  SELECT COALESCE(c.id_centro_custo, p.id_centro_custo) AS id_centro_custo, CAST(c.r AS DOUBLE) AS realizado_atual,
         CAST(p.r AS DOUBLE) AS realizado_anterior, CAST(COALESCE(c.r, 0) - COALESCE(p.r, 0) AS DOUBLE) AS yoy_abs,
         round(CAST(c.r AS DOUBLE) / CAST(NULLIF(p.r, 0) AS DOUBLE) - 1, 6) AS yoy_perc
  FROM cur c FULL OUTER JOIN prev p ON c.id_centro_custo = p.id_centro_custo)
"""


@register("m11", q(_yoy_sql(f"data_lancamento BETWEEN {MS} AND {A}", f"data_lancamento BETWEEN {MS_LY} AND {A_LY}")
                   + f"SELECT * FROM yoy ORDER BY yoy_perc DESC NULLS LAST, id_centro_custo LIMIT {K}"))
def m11(spark, sf_dir):
    return measures.top_growth(silver(spark, sf_dir), CFG)


@register("m12", q(f"""
SELECT CAST(SUM(valor) AS DOUBLE) AS total,
       CAST(COALESCE(SUM(valor) FILTER (WHERE status_pagamento = 'Aberto'), 0) AS DOUBLE) AS total_pendente,
       round(CAST(COALESCE(SUM(valor) FILTER (WHERE status_pagamento = 'Aberto'), 0) AS DOUBLE) / CAST(SUM(valor) AS DOUBLE), 6)
         AS perc_pendente
FROM fact_lancamentos WHERE data_lancamento BETWEEN {MS} AND {A}
"""))
def m12(spark, sf_dir):
    return measures.pending_payables(silver(spark, sf_dir), CFG)


@register("m13", q(f"""
, dd AS (SELECT data_lancamento, SUM(valor) AS t FROM fact_lancamentos WHERE data_lancamento BETWEEN {MS} AND {A} GROUP BY 1)
SELECT data_lancamento, CAST(t AS DOUBLE) AS total_dia,
       CAST(SUM(t) OVER (ORDER BY data_lancamento ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS acumulado,
       round(CAST(SUM(t) OVER (ORDER BY data_lancamento ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
             / CAST(SUM(t) OVER () AS DOUBLE), 6) AS perc_acumulado
FROM dd
"""))
def m13(spark, sf_dir):
    return measures.daily_cumulative(silver(spark, sf_dir), CFG)


@register("m14", q(f"""
, o AS (SELECT SUM(valor) AS v FROM fact_orcamento WHERE ano = {Y} AND mes <= {M}),
r AS (SELECT SUM(valor) AS v FROM fact_lancamentos WHERE data_lancamento BETWEEN DATE '{Y}-01-01' AND {A})
SELECT {Y} AS ano, CAST(o.v AS DOUBLE) AS orcado_ytd, CAST(r.v AS DOUBLE) AS realizado_ytd,
       CAST(COALESCE(r.v, 0) - COALESCE(o.v, 0) AS DOUBLE) AS desvio,
       round(CAST(COALESCE(r.v, 0) - COALESCE(o.v, 0) AS DOUBLE) / CAST(NULLIF(o.v, 0) AS DOUBLE), 6) AS perc_desvio
FROM o, r
"""))
def m14(spark, sf_dir):
    return measures.annual_kpis(silver(spark, sf_dir), CFG)


BVA = """
, orc AS (SELECT ano, mes, id_centro_custo, id_categoria, SUM(valor) AS orcado FROM fact_orcamento GROUP BY 1, 2, 3, 4),
real AS (SELECT CAST(year(data_lancamento) AS INTEGER) AS ano, CAST(month(data_lancamento) AS INTEGER) AS mes,
                id_centro_custo, id_categoria, SUM(valor) AS realizado FROM fact_lancamentos GROUP BY 1, 2, 3, 4),
bva AS (SELECT COALESCE(o.ano, r.ano) AS ano, COALESCE(o.mes, r.mes) AS mes,
               COALESCE(o.id_centro_custo, r.id_centro_custo) AS id_centro_custo, o.orcado, r.realizado,
               COALESCE(r.realizado, 0) - COALESCE(o.orcado, 0) AS desvio
        FROM orc o FULL OUTER JOIN real r ON o.ano = r.ano AND o.mes = r.mes
             AND o.id_centro_custo = r.id_centro_custo AND o.id_categoria = r.id_categoria)
"""


@register("m15", q(BVA + """
SELECT CAST(ano * 100 + mes AS INTEGER) AS ano_mes, CAST(SUM(orcado) AS DOUBLE) AS orcado,
       CAST(SUM(realizado) AS DOUBLE) AS realizado, CAST(SUM(desvio) AS DOUBLE) AS desvio
FROM bva GROUP BY 1
"""))
def m15(spark, sf_dir):
    return measures.monthly_variance(silver(spark, sf_dir))


@register("m16", q(BVA + "SELECT id_centro_custo, " + ", ".join(
    f"CAST(SUM(CASE WHEN mes = {m} THEN desvio END) AS DOUBLE) AS m{m:02d}" for m in range(1, 13))
    + f" FROM bva WHERE ano = {Y} GROUP BY 1"))
def m16(spark, sf_dir):
    return measures.variance_matrix(silver(spark, sf_dir), CFG)


@register("m17", q(f"""
SELECT CAST(month(data_lancamento) AS INTEGER) AS mes,
       CAST(SUM(CASE WHEN year(data_lancamento) = {Y - 1} THEN valor END) AS DOUBLE) AS ano_anterior,
       CAST(SUM(CASE WHEN year(data_lancamento) = {Y} THEN valor END) AS DOUBLE) AS ano_atual
FROM fact_lancamentos WHERE year(data_lancamento) IN ({Y - 1}, {Y}) GROUP BY 1
"""))
def m17(spark, sf_dir):
    return measures.yoy_monthly(silver(spark, sf_dir), CFG)


@register("m18", q(_yoy_sql(f"data_lancamento BETWEEN DATE '{Y}-01-01' AND {A}",
                            f"data_lancamento BETWEEN DATE '{Y - 1}-01-01' AND {A_LY}") + "SELECT * FROM yoy"))
def m18(spark, sf_dir):
    return measures.ytd_vs_last_year(silver(spark, sf_dir), CFG)


@register("m19", q(_yoy_sql(f"year(data_lancamento) = {Y} AND month(data_lancamento) = {M}",
                            f"year(data_lancamento) = {Y - 1} AND month(data_lancamento) = {M}") + "SELECT * FROM yoy"))
def m19(spark, sf_dir):
    return measures.growth_table(silver(spark, sf_dir), CFG)


@register("m20", q(PROJ_CC + """
SELECT id_centro_custo, round(final, 2) AS projecao_fechamento, orcado,
       round(final - COALESCE(orcado, 0.0), 2) AS resultado_previsto
FROM proj_cc2
"""))
def m20(spark, sf_dir):
    return measures.forecast_vs_budget(silver(spark, sf_dir), CFG)


@register("m21", q(REF + f"""
, days AS (SELECT mes, dia FROM dim_calendario WHERE ano = {Y} AND mes = {M}),
tw AS (SELECT dia, peso_do_dia AS w_day, valor_mediano_dia FROM ref_all),
orc_tot AS (SELECT CAST(SUM(valor) AS DOUBLE) AS orc FROM fact_orcamento WHERE ano = {Y} AND mes = {M}),
daily AS (SELECT CAST(day(data_lancamento) AS INTEGER) AS dia, SUM(valor) AS t FROM fact_lancamentos
          WHERE data_lancamento BETWEEN {MS} AND {A} GROUP BY 1),
tot AS (SELECT SUM(valor) AS realizado FROM fact_lancamentos WHERE data_lancamento BETWEEN {MS} AND {A}),
tproj AS (
  SELECT CAST(t.realizado AS DOUBLE) AS r, wn.w AS w_now, wf.w AS w_final,
         CAST(t.realizado AS DOUBLE) / {D} * {DIM} AS linear,
         CAST(t.realizado AS DOUBLE) / NULLIF(wn.w, 0.0) * wf.w AS hist
  FROM tot t, (SELECT max(w_day) AS w FROM tw WHERE dia = {D}) wn, (SELECT max(w_day) AS w FROM tw WHERE dia = {DIM}) wf),
tproj2 AS (SELECT *, {LW} * linear + {HW} * COALESCE(hist, linear) AS final FROM tproj),
grid AS (
  SELECT dd.dia, tw.w_day, tw.valor_mediano_dia, daily.t, orc_tot.orc, tproj2.*
  FROM days dd LEFT JOIN tw ON tw.dia = dd.dia LEFT JOIN daily ON daily.dia = dd.dia, orc_tot, tproj2)
SELECT dia, round(orc * w_day, 4) AS orcado_ideal_mtd,
       CASE WHEN dia <= {D} THEN CAST(SUM(COALESCE(t, 0)) OVER (ORDER BY dia ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) END
         AS realizado_mtd,
       valor_mediano_dia AS mediana_historica_mtd,
       CASE WHEN dia >= {D} THEN round(r + (final - r) * COALESCE((w_day - w_now) / NULLIF(w_final - w_now, 0.0), 0.0), 4) END
         AS projecao
FROM grid
"""))
def m21(spark, sf_dir):
    return measures.pace_table(silver(spark, sf_dir), CFG)
