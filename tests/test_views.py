"""SQL written against the reference's view names runs through spark.sql."""

import os

import pytest

from conftest import SMOKE_DIR, rows
from ledgerlight.plans import gold, views
from ledgerlight.plans.config import TESTDATA
from ledgerlight.plans.registry import silver


@pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="test data not present")
def test_reference_style_sql_on_registered_views(spark):
    sv = silver(spark, SMOKE_DIR)
    names = views.register(spark, sv, TESTDATA)
    assert "vw_gold_realizado" in names and "vw_lancamentos" in names and "fact_lancamentos" in names
    cfg = TESTDATA.with_(report_start=TESTDATA.report_start.replace(day=1), report_end=TESTDATA.report_end)
    # the ad-hoc MTD report, written the way the reference writes it (mixed-case names)
    rep = spark.sql(f"""
        SELECT DAY(data_lancamento) AS DIA, centro_de_custo, SUM(valor) AS VALOR,
               SUM(gasto_MTD_CC_CAT) AS `GASTOS MTD CC CAT`
        FROM vw_gold_lancamentos
        WHERE centro_de_custo = '{cfg.report_cost_centre}'
          AND data_lancamento BETWEEN DATE '{cfg.report_start}' AND DATE '{cfg.report_end}'
          AND status_pagamento = 'Pago'
        GROUP BY DAY(data_lancamento), centro_de_custo
        ORDER BY DAY(data_lancamento)""")
    want = gold.mtd_report(sv, cfg)
    assert rows(rep, "DIA", "VALOR", "GASTOS MTD CC CAT") == rows(want, "dia", "valor", "gastos_mtd_cc_cat")
    # names with a blank or an accent, as in the reference
    r = spark.sql("SELECT Ano, Mes, `Realizado YTD`, `Média_mensal`, MoM_perc FROM vw_gold_realizado "
                  "WHERE Ano IS NOT NULL LIMIT 5").collect()
    assert len(r) == 5
    assert spark.sql("SELECT COUNT(*) FROM vw_lancamentos WHERE id_cc = -1").first()[0] > 0
    assert spark.sql("SELECT `Partipação no mês` FROM vw_gold_lancamentos_consolidados_dia LIMIT 1").count() == 1
