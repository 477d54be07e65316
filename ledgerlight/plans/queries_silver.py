"""Registered cleansing (S), calendar (C), join (J), aggregation (A) and
window (W) operators, each over the whole test tables, with SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlight import schemas as S
from ledgerlight.functions.safe import money, rnd
from ledgerlight.operators import calendar, cleanse, grid
from ledgerlight.operators.joins import anti_join, bounded, with_scalars
from ledgerlight.plans import gold
from ledgerlight.plans.config import TESTDATA as CFG
from ledgerlight.plans.oracle_sql import q, sentence
from ledgerlight.plans.queries_gold import (
    ACTUAL_MONTHLY, BUDGET_MONTHLY, DAY_TOTALS, G2_CTES, G8_BASE, LEDGER_ENRICHED, MTD_HISTORY, REFERENCIA_FINE, STATUS_DAYS, view_ctes,
)
from ledgerlight.plans.registry import register, silver, staging


# ====================================================================== S
@register("s1", q("""
SELECT TRY_CAST(id_orcamento AS INTEGER) AS id_orcamento, TRY_CAST(ano AS INTEGER) AS ano,
       TRY_CAST(mes AS INTEGER) AS mes, TRY_CAST(id_centro_custo AS INTEGER) AS id_centro_custo,
       TRY_CAST(id_categoria AS INTEGER) AS id_categoria,
       CAST(TRY_CAST(valor_orcado AS DECIMAL(18,2)) AS DOUBLE) AS valor_orcado
FROM stg_orcamento
"""))
def s1(spark, sf_dir):
    t = cleanse.typed_projection(staging(spark, sf_dir)["stg_orcamento"], {
        "id_orcamento": "int", "ano": "int", "mes": "int", "id_centro_custo": "int",
        "id_categoria": "int", "valor_orcado": "decimal(18,2)"})
    return t.withColumn("valor_orcado", money("valor_orcado"))


@register("s2", q("""
SELECT TRY_CAST(id_lancamento AS BIGINT) AS id_lancamento,
       CAST(TRUNC(TRY_CAST(id_campanha_marketing AS DOUBLE)) AS INTEGER) AS id_campanha_marketing
FROM stg_lancamentos
"""))
def s2(spark, sf_dir):
    t = staging(spark, sf_dir)["stg_lancamentos"].select("id_lancamento", "id_campanha_marketing")
    t = cleanse.float_keys_to_int(t, ["id_campanha_marketing"])
    return t.withColumn("id_lancamento", F.col("id_lancamento").try_cast("long"))


@register("s3", q(f"""
SELECT id_cc, nome_cc AS nome_original, {sentence('nome_cc')} AS nome_cc FROM stg_dim_centro_custo
"""))
def s3(spark, sf_dir):
    t = staging(spark, sf_dir)["stg_dim_centro_custo"].withColumn("nome_original", F.col("nome_cc"))
    return cleanse.sentence_case_names(t, ["nome_cc"]).select("id_cc", "nome_original", "nome_cc")


@register("s4", q("""
SELECT id_lancamento, id_fornecedor FROM stg_lancamentos WHERE id_fornecedor IS NOT NULL
"""))
def s4(spark, sf_dir):
    t = staging(spark, sf_dir)["stg_lancamentos"].select("id_lancamento", "id_fornecedor")
    return cleanse.drop_null_keys(t, ["id_fornecedor"])


@register("s5", q("""
SELECT id_lancamento, data_lancamento FROM stg_lancamentos WHERE data_lancamento IS NOT NULL
"""))
def s5(spark, sf_dir):
    t = staging(spark, sf_dir)["stg_lancamentos"].select("id_lancamento", "data_lancamento")
    return cleanse.drop_null_keys(t, ["data_lancamento"])


@register("s6", q("""
SELECT id_lancamento, id_centro_custo FROM vw_lancamentos
"""))
def s6(spark, sf_dir):
    sv = silver(spark, sf_dir)
    return sv.vw_lancamentos.select("id_lancamento", "id_centro_custo")


@register("s7", q("SELECT id_cc, nome_cc FROM dim_centro_custo"))
def s7(spark, sf_dir):
    return silver(spark, sf_dir).dim_centro_custo


@register("s8", q("""
SELECT TRY_CAST(id_lancamento AS BIGINT) AS id_lancamento,
       CAST(abs(TRY_CAST(valor_lancamento AS DECIMAL(16,2))) AS DOUBLE) AS valor,
       CAST(TRY_CAST(valor_lancamento AS DECIMAL(16,2)) AS DOUBLE) AS valor_original
FROM stg_lancamentos
"""))
def s8(spark, sf_dir):
    t = staging(spark, sf_dir)["stg_lancamentos"].select(
        F.col("id_lancamento").try_cast("long").alias("id_lancamento"),
        F.col("valor_lancamento").try_cast(S.MONEY_LEDGER).alias("valor"))
    t = cleanse.sign_repair(t, "valor", "valor", "valor_original")
    return t.select("id_lancamento", money("valor").alias("valor"), money("valor_original").alias("valor_original"))


@register("s9", q("""
SELECT id_lancamento, status_pagamento AS status_original,
       CASE WHEN upper(rtrim(status_pagamento)) IN ('PAGO', 'PAGA') THEN 'Pago'
            WHEN upper(rtrim(status_pagamento)) IN ('PENDING', 'ABERTO') THEN 'Aberto' ELSE 'Outros' END AS status_pagamento
FROM stg_lancamentos
"""))
def s9(spark, sf_dir):
    t = staging(spark, sf_dir)["stg_lancamentos"].select(
        "id_lancamento", F.col("status_pagamento").alias("status_original"), "status_pagamento")
    return cleanse.normalise_category(t, "status_pagamento")


@register("s10", q("SELECT id_orcamento, CAST(valor AS DOUBLE) AS valor, status_dado FROM vw_orcamento"))
def s10(spark, sf_dir):
    return silver(spark, sf_dir).vw_orcamento.select("id_orcamento", money("valor").alias("valor"), "status_dado")


@register("s11", q("SELECT id_orcamento, ano, mes, data_orcamento FROM vw_orcamento"))
def s11(spark, sf_dir):
    return silver(spark, sf_dir).vw_orcamento.select("id_orcamento", "ano", "mes", "data_orcamento")


@register("s12", q("""
SELECT 'dim_camp_marketing' AS tabela, id_camp AS id, nome_campanha AS nome FROM dim_camp_marketing
UNION ALL SELECT 'dim_centro_custo', id_cc, nome_cc FROM dim_centro_custo
UNION ALL SELECT 'dim_categoria', id_categoria, nome_categoria FROM dim_categoria
UNION ALL SELECT 'dim_fornecedores', id_forn, nome_forn FROM dim_fornecedores
"""))
def s12(spark, sf_dir):
    sv = silver(spark, sf_dir)
    parts = [(sv.dim_camp_marketing, "id_camp", "nome_campanha", "dim_camp_marketing"),
             (sv.dim_centro_custo, "id_cc", "nome_cc", "dim_centro_custo"),
             (sv.dim_categoria, "id_categoria", "nome_categoria", "dim_categoria"),
             (sv.dim_fornecedores, "id_forn", "nome_forn", "dim_fornecedores")]
    out = None
    for df, k, n, name in parts:
        p = df.select(F.lit(name).alias("tabela"), F.col(k).alias("id"), F.col(n).alias("nome"))
        out = p if out is None else out.unionByName(p)
    return out


@register("s13", q("""
SELECT id_lancamento, data_lancamento, id_centro_custo, id_categoria, id_fornecedor, id_campanha,
       CAST(valor AS DOUBLE) AS valor, CAST(valor_original AS DOUBLE) AS valor_original, status_pagamento
FROM vw_lancamentos
"""))
def s13(spark, sf_dir):
    v = silver(spark, sf_dir).vw_lancamentos
    return v.withColumn("valor", money("valor")).withColumn("valor_original", money("valor_original"))


@register("s14", q("""
SELECT id_orcamento, data_orcamento, ano, mes, id_centro_custo, id_categoria, CAST(valor AS DOUBLE) AS valor,
       status_dado
FROM vw_orcamento
"""))
def s14(spark, sf_dir):
    return silver(spark, sf_dir).vw_orcamento.withColumn("valor", money("valor"))


@register("s15", q(LEDGER_ENRICHED + """
SELECT id_lancamento,
       CASE WHEN trim(fornecedor) IS NULL OR length(trim(fornecedor)) = 0 THEN 'Sem Informação' ELSE trim(fornecedor) END AS fornecedor,
       CASE WHEN trim(campanha_de_marketing) IS NULL OR length(trim(campanha_de_marketing)) = 0 THEN 'Sem Informação'
            ELSE trim(campanha_de_marketing) END AS campanha_de_marketing
FROM ledger_enriched
"""))
def s15(spark, sf_dir):
    e = gold.ledger_enriched(silver(spark, sf_dir)).select("id_lancamento", "fornecedor", "campanha_de_marketing")
    return cleanse.fill_label(e, ["fornecedor", "campanha_de_marketing"])


# ====================================================================== C
def _data_calendar(spark, sf_dir):
    return calendar.calendar_for(silver(spark, sf_dir).fact_lancamentos, "data_lancamento")


@register("c1", q("SELECT data FROM cal_days"))
def c1(spark, sf_dir):
    return _data_calendar(spark, sf_dir)


@register("c2", q("SELECT * FROM dim_calendario"))
def c2(spark, sf_dir):
    return calendar.calendar_attributes(_data_calendar(spark, sf_dir))


@register("c3", q("""
SELECT DISTINCT CAST(year(data) * 100 + month(data) AS INTEGER) AS ano_mes, CAST(year(data) AS INTEGER) AS ano,
       CAST(month(data) AS INTEGER) AS mes, CAST(date_trunc('month', data) AS DATE) AS primeiro_dia,
       last_day(data) AS ultimo_dia
FROM dim_calendario
"""))
def c3(spark, sf_dir):
    return calendar.dim_mes(calendar.calendar_attributes(_data_calendar(spark, sf_dir)))


# ====================================================================== J
@register("j1", q(LEDGER_ENRICHED + """
SELECT id_lancamento, data_lancamento, id_centro_de_custo, centro_de_custo, id_categoria, categoria,
       id_fornecedor, fornecedor, id_campanha, campanha_de_marketing, CAST(valor AS DOUBLE) AS valor,
       status_pagamento
FROM ledger_enriched
"""))
def j1(spark, sf_dir):
    e = gold.ledger_enriched(silver(spark, sf_dir))
    return e.select(*gold.LEDGER_COLUMNS[:10], money("valor").alias("valor"), "status_pagamento")


@register("j2", q(ACTUAL_MONTHLY + """
SELECT cal_ano, cal_mes, b.ano, b.mes, b.id_centro_de_custo, b.id_categoria, CAST(b.realizado AS DOUBLE) AS realizado
FROM (SELECT DISTINCT ano AS cal_ano, mes AS cal_mes FROM dim_calendario) c
LEFT JOIN actual_monthly b ON b.ano = c.cal_ano AND b.mes = c.cal_mes
"""))
def j2(spark, sf_dir):
    return gold.on_months(gold.actual_monthly(silver(spark, sf_dir))).select("cal_ano", "cal_mes", "ano", "mes", "id_centro_de_custo", "id_categoria",
                    money("realizado").alias("realizado"))


@register("j3", q("""
SELECT DISTINCT c.data AS data_lancamento, l.id_centro_custo, l.id_categoria FROM fact_lancamentos l JOIN dim_calendario c ON true
"""))
def j3(spark, sf_dir):
    sv = silver(spark, sf_dir)
    combos = sv.fact_lancamentos.select("id_centro_custo", "id_categoria").distinct()
    return grid.dense_grid(combos, sv.calendar_span, "data_lancamento") \
               .select("data_lancamento", "id_centro_custo", "id_categoria")


@register("j4", q(DAY_TOTALS + """
SELECT data_lancamento, id_centro_custo, id_categoria, CAST(total_do_dia AS DOUBLE) AS total_do_dia FROM filled_grid
"""))
def j4(spark, sf_dir):
    h = gold.daily_grid(silver(spark, sf_dir))
    return h.select("data_lancamento", "id_centro_custo", "id_categoria", money("total_do_dia").alias("total_do_dia"))


@register("j5", q("""
SELECT id_lancamento, id_centro_custo FROM stg_lancamentos
WHERE id_centro_custo NOT IN (SELECT CAST(id_cc AS VARCHAR) FROM dim_centro_custo)
"""))
def j5(spark, sf_dir):
    sv = silver(spark, sf_dir)
    stg = staging(spark, sf_dir)["stg_lancamentos"].select("id_lancamento", "id_centro_custo")
    keys = sv.dim_centro_custo.select(F.col("id_cc").cast("string").alias("cc_key"))
    return anti_join(stg, keys, "id_centro_custo", "cc_key")


@register("j6", q("""
SELECT data FROM dim_calendario WHERE data <= (SELECT MAX(data_lancamento) FROM fact_lancamentos)
"""))
def j6(spark, sf_dir):
    sv = silver(spark, sf_dir)
    last = sv.fact_lancamentos.agg(F.max("data_lancamento").alias("__last"))   # scalar subquery
    return with_scalars(sv.dim_calendario, last).filter(F.col("data") <= F.col("__last")).select("data")


@register("j8", q(G8_BASE + """
SELECT ano, mes, id_centro_custo, id_categoria, CAST(orcado AS DOUBLE) AS orcado, CAST(realizado AS DOUBLE) AS realizado
FROM bva
"""))
def j8(spark, sf_dir):
    sv = silver(spark, sf_dir)
    orc = sv.fact_orcamento.groupBy("ano", "mes", "id_centro_custo", "id_categoria").agg(F.sum("valor").alias("orcado"))
    real = sv.fact_lancamentos.groupBy(F.year("data_lancamento").alias("ano"), F.month("data_lancamento").alias("mes"),
                                       "id_centro_custo", "id_categoria").agg(F.sum("valor").alias("realizado"))
    j = orc.join(real, ["ano", "mes", "id_centro_custo", "id_categoria"], "full_outer")
    return j.select("ano", "mes", "id_centro_custo", "id_categoria", money("orcado").alias("orcado"),
                    money("realizado").alias("realizado"))


@register("j9", q("""
, daily AS (SELECT data_lancamento, id_centro_custo, id_categoria, SUM(valor) AS realizado_dia
            FROM fact_lancamentos GROUP BY 1, 2, 3),
monthly_budget AS (SELECT CAST(ano * 100 + mes AS INTEGER) AS ano_mes, id_centro_custo, id_categoria,
                          SUM(valor) AS orcado_mes FROM fact_orcamento GROUP BY 1, 2, 3)
SELECT dl.data_lancamento, dl.id_centro_custo, dl.id_categoria, c.ano_mes,
       CAST(dl.realizado_dia AS DOUBLE) AS realizado_dia, CAST(b.orcado_mes AS DOUBLE) AS orcado_mes
FROM daily dl JOIN dim_calendario c ON c.data = dl.data_lancamento
LEFT JOIN monthly_budget b ON b.ano_mes = c.ano_mes AND b.id_centro_custo = dl.id_centro_custo
     AND b.id_categoria = dl.id_categoria
"""))
def j9(spark, sf_dir):
    sv = silver(spark, sf_dir)
    daily = grid.daily_totals(sv.fact_lancamentos, "data_lancamento", ["id_centro_custo", "id_categoria"],
                              "valor", "realizado_dia")
    cal = sv.calendar_side(sv.dim_calendario.select(F.col("data").alias("cal_data"), "ano_mes"))
    budget = sv.fact_orcamento.groupBy(F.expr("CAST(ano * 100 + mes AS INT)").alias("b_ano_mes"),
                                       F.col("id_centro_custo").alias("b_cc"), F.col("id_categoria").alias("b_cat")) \
                              .agg(F.sum("valor").alias("orcado_mes"))
    j = daily.join(cal, F.col("data_lancamento") == F.col("cal_data"))
    j = j.join(budget, (F.col("b_ano_mes") == F.col("ano_mes")) & (F.col("b_cc") == F.col("id_centro_custo"))
               & (F.col("b_cat") == F.col("id_categoria")), "left")
    return j.select("data_lancamento", "id_centro_custo", "id_categoria", "ano_mes",
                    money("realizado_dia").alias("realizado_dia"), money("orcado_mes").alias("orcado_mes"))


# ====================================================================== A
@register("a1", q(BUDGET_MONTHLY + """
SELECT ano, mes, id_centro_de_custo, centro_de_custo, id_categoria, categoria, status_dado,
       CAST(orcado AS DOUBLE) AS orcado FROM budget_monthly
"""))
def a1(spark, sf_dir):
    return gold.budget_monthly(silver(spark, sf_dir)).withColumn("orcado", money("orcado"))


@register("a2", q(ACTUAL_MONTHLY + """
SELECT ano, mes, ano_mes, id_centro_de_custo, centro_de_custo, id_categoria, categoria,
       CAST(realizado AS DOUBLE) AS realizado, flag_centro_custo_coringa FROM actual_monthly
"""))
def a2(spark, sf_dir):
    return gold.actual_monthly(silver(spark, sf_dir)).withColumn("realizado", money("realizado"))


@register("a3", q("""
SELECT data_lancamento, id_centro_custo, id_categoria, CAST(SUM(valor) AS DOUBLE) AS total_do_dia
FROM fact_lancamentos GROUP BY 1, 2, 3
"""))
def a3(spark, sf_dir):
    fl = silver(spark, sf_dir).fact_lancamentos
    return grid.daily_totals(fl, "data_lancamento", ["id_centro_custo", "id_categoria"], "valor", "total_do_dia") \
               .withColumn("total_do_dia", money("total_do_dia"))


@register("a4", q(STATUS_DAYS + """
SELECT data AS data_lancamento, id_centro_custo, id_categoria, status_pagamento, CAST(valor AS DOUBLE) AS valor_dia FROM paid_days
"""))
def a4(spark, sf_dir):
    fl = silver(spark, sf_dir).fact_lancamentos
    t = fl.withColumn("status_pagamento",
                      F.replace(F.col("status_pagamento"), F.lit(S.STATUS_OPEN), F.lit(S.STATUS_PENDING)))
    return grid.daily_totals(t, "data_lancamento", ["id_centro_custo", "id_categoria", "status_pagamento"],
                             "valor", "valor_dia").withColumn("valor_dia", money("valor_dia"))


@register("a5", q(LEDGER_ENRICHED + """
SELECT data_lancamento, id_centro_de_custo, id_categoria, id_fornecedor, status_pagamento,
       CAST(SUM(valor) AS DOUBLE) AS total_do_dia
FROM ledger_enriched GROUP BY 1, 2, 3, 4, 5
"""))
def a5(spark, sf_dir):
    e = gold.ledger_enriched(silver(spark, sf_dir))
    return grid.daily_totals(e, "data_lancamento", ["id_centro_de_custo", "id_categoria", "id_fornecedor",
                                                    "status_pagamento"], "valor", "total_do_dia") \
               .withColumn("total_do_dia", money("total_do_dia"))


@register("a6", q("SELECT DISTINCT id_centro_custo, id_categoria FROM fact_lancamentos"))
def a6(spark, sf_dir):
    return silver(spark, sf_dir).fact_lancamentos.select("id_centro_custo", "id_categoria").distinct()


def _sum_branch(cc, cat, group):
    return (f"SELECT dia, {cc} AS id_centro_custo, {cat} AS id_categoria, CAST(SUM(valor) AS DOUBLE) AS total, "
            f"COUNT(*) AS lancamentos FROM fl_dia GROUP BY {group}")


@register("a7", q(", fl_dia AS (SELECT CAST(day(data_lancamento) AS INTEGER) AS dia, * FROM fact_lancamentos)\n"
                  + "\nUNION ALL\n".join([
                      _sum_branch("id_centro_custo", "id_categoria", "dia, id_centro_custo, id_categoria"),
                      _sum_branch("id_centro_custo", "-999", "dia, id_centro_custo"),
                      _sum_branch("-999", "id_categoria", "dia, id_categoria"),
                      _sum_branch("-999", "-999", "dia")])))
def a7(spark, sf_dir):
    fl = silver(spark, sf_dir).fact_lancamentos.withColumn("dia", F.dayofmonth("data_lancamento"))
    opt = ["id_centro_custo", "id_categoria"]
    g = fl.groupingSets([["dia", *opt], ["dia", "id_centro_custo"], ["dia", "id_categoria"], ["dia"]], "dia", *opt) \
          .agg(money(F.sum("valor")).alias("total"), F.count(F.lit(1)).alias("lancamentos"),
               *[F.grouping(k).alias(f"__g_{k}") for k in opt])
    keys = [F.when(F.col(f"__g_{k}") == 1, F.lit(S.ALL_MEMBERS)).otherwise(F.col(k)).alias(k) for k in opt]
    return g.select("dia", *keys, "total", "lancamentos")


@register("a8", q(REFERENCIA_FINE))
def a8(spark, sf_dir):
    return gold.gold_referencia_mtd(silver(spark, sf_dir), CFG, sets=[["id_centro_custo", "id_categoria"]])


@register("a8d", q(REFERENCIA_FINE))
def a8d(spark, sf_dir):
    """A8 with coarse value ranges (see G4D)."""
    return gold.gold_referencia_mtd(silver(spark, sf_dir), CFG, sets=[["id_centro_custo", "id_categoria"]], bits=0)


@register("a9", q("""
SELECT data_lancamento, id_fornecedor, COUNT(id_fornecedor) AS contagem
FROM fact_lancamentos GROUP BY 1, 2 HAVING COUNT(id_fornecedor) > 1
"""))
def a9(spark, sf_dir):
    fl = silver(spark, sf_dir).fact_lancamentos
    g = fl.groupBy("data_lancamento", "id_fornecedor").agg(F.count("id_fornecedor").alias("contagem"))
    return g.filter(F.col("contagem") > 1)


# ====================================================================== W
def _w(key: str, view: str, cols: str, fn):
    register(key, q(view_ctes(view) + f"SELECT {cols} FROM v_{view}"))(fn)


_G1_KEY = "ano, mes, id_centro_de_custo, id_categoria, status_dado"
_G2_KEY = "ano, mes, id_centro_de_custo, id_categoria"


def _g1(cols):
    return lambda spark, sf_dir: gold.gold_orcamento(silver(spark, sf_dir)).select(*cols)


def _g2(cols):
    return lambda spark, sf_dir: gold.gold_realizado(silver(spark, sf_dir)).select(*cols)


def _split(s):
    return [c.strip() for c in s.split(",")]


for _k, _c in {"w1": "orcado_ytd", "w7": "media_mensal", "w8": "peso_centro_custo", "w9": "peso_categoria",
               "w10": "flag_valor_atipico_orcamento"}.items():
    _cols = f"{_G1_KEY}, {_c}" + (", orcado_mensal" if _k in ("w7", "w10") else "")
    _w(_k, "g1", _cols, _g1(_split(_cols)))

for _k, _c in {"w2": "realizado_ytd", "w3": "mom_abs", "w4": "mom_perc", "w5": "yoy_abs", "w6": "yoy_perc",
               "w11": "flag_valor_atipico_realizado"}.items():
    _cols = f"{_G2_KEY}, realizado, {_c}"
    _w(_k, "g2", _cols, _g2(_split(_cols)))


def _calendar_lag_sql() -> str:
    def prev(alias, k):
        return (f"LEFT JOIN g {alias} ON {alias}.ano * 12 + {alias}.mes + {k} = a.ano * 12 + a.mes "
                f"AND {alias}.id_centro_de_custo IS NOT DISTINCT FROM a.id_centro_de_custo "
                f"AND {alias}.id_categoria IS NOT DISTINCT FROM a.id_categoria")
    return G2_CTES + """
, g AS (SELECT ano, mes, id_centro_de_custo, id_categoria, CAST(realizado AS DOUBLE) AS realizado FROM scaffold)
SELECT a.ano, a.mes, a.id_centro_de_custo, a.id_categoria, a.realizado,
       a.realizado - NULLIF(p1.realizado, 0) AS mom_abs, round(a.realizado / NULLIF(p1.realizado, 0) - 1, 6) AS mom_perc,
       a.realizado - NULLIF(p12.realizado, 0) AS yoy_abs, round(a.realizado / NULLIF(p12.realizado, 0) - 1, 6) AS yoy_perc
FROM g a """ + prev("p1", 1) + "\n" + prev("p12", 12)


@register("w3c", q(_calendar_lag_sql()))
def w3c(spark, sf_dir):
    """MoM / YoY against the calendar month: a range window over the month index instead of LAG over rows."""
    return gold.gold_realizado(silver(spark, sf_dir), lag_mode="calendar").select(
        *_split(_G2_KEY), "realizado", "mom_abs", "mom_perc", "yoy_abs", "yoy_perc")


_MTD_COLS = "id_lancamento, data_lancamento, valor"
_w("w12", "g3", f"{_MTD_COLS}, gasto_mtd",
   lambda spark, sf_dir: gold.gold_lancamentos(silver(spark, sf_dir)).select(*_split(_MTD_COLS), "gasto_mtd"))
_w("w13", "g3", f"{_MTD_COLS}, gasto_mtd_cc_cat",
   lambda spark, sf_dir: gold.gold_lancamentos(silver(spark, sf_dir)).select(*_split(_MTD_COLS), "gasto_mtd_cc_cat"))


def _hist(cols, cut):
    def fn(spark, sf_dir):
        h = gold.mtd_history(silver(spark, sf_dir), CFG, cut)
        out = {"gasto_mtd": money("gasto_mtd"), "total_do_mes": money("total_do_mes"),
               "perc_gasto_mes": rnd("perc_gasto_mes", 6)}
        return h.select("data_lancamento", "id_centro_custo", "id_categoria", *[out[c].alias(c) for c in cols])
    return fn


# the history cut comes after W14 and W15
for _k, _c, _sql, _rows in (("w14", "gasto_mtd", "CAST(gasto_mtd AS DOUBLE) AS gasto_mtd", "all_history"),
                            ("w15", "total_do_mes", "CAST(total_do_mes AS DOUBLE) AS total_do_mes", "all_history"),
                            ("w16", "perc_gasto_mes", "round(perc_gasto_mes, 6) AS perc_gasto_mes", "history_rows")):
    register(_k, q(MTD_HISTORY + f"SELECT data_lancamento, id_centro_custo, id_categoria, {_sql} FROM {_rows}"))(
        _hist([_c], _k == "w16"))

_G5_COLS = "data_lancamento, id_centro_custo, id_categoria, status_pagamento, gasto_mtd_agregado"
_w("w17", "g5", _G5_COLS,
   lambda spark, sf_dir: gold.gold_lancamentos_diarios(silver(spark, sf_dir)).select(*_split(_G5_COLS)))
_G6_COLS = "data_lancamento, id_centro_de_custo, id_categoria, id_fornecedor, status_pagamento, total_do_dia, participacao_no_mes"
_w("w18", "g6", _G6_COLS,
   lambda spark, sf_dir: gold.gold_lancamentos_consolidados_dia(silver(spark, sf_dir)).select(*_split(_G6_COLS)))


@register("w19", q("""
SELECT id_centro_custo, id_categoria,
       round(CAST(SUM(valor) AS DOUBLE) / COUNT(valor), 6) AS media, COUNT(*) AS meses
FROM vw_orcamento GROUP BY 1, 2
"""))
def w19(spark, sf_dir):
    o = silver(spark, sf_dir).vw_orcamento
    return o.groupBy("id_centro_custo", "id_categoria").agg(
        rnd(F.sum("valor").cast("double") / F.count("valor"), 6).alias("media"),
        F.count(F.lit(1)).alias("meses"))


@register("w20", q(MTD_HISTORY + """
SELECT dia, id_centro_custo, id_categoria, round(quantile_cont(perc_gasto_mes, 0.5), 6) AS peso_do_dia FROM history_rows GROUP BY ALL
"""))
def w20(spark, sf_dir):
    m = gold.gold_referencia_mtd(silver(spark, sf_dir), CFG, sets=[["id_centro_custo", "id_categoria"]])
    return m.select("dia", "id_centro_custo", "id_categoria", "peso_do_dia")
