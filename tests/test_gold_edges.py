"""Edge cases of the gold operators on a small hand-made star schema."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerlight import schemas as S
from ledgerlight.operators import grid, rules
from ledgerlight.operators.joins import anti_join
from ledgerlight.plans import gold
from ledgerlight.plans import silver as silver_plan
from ledgerlight.plans.config import Config

CFG = Config(calendar_start=dt.date(2024, 1, 1), calendar_end=dt.date(2024, 3, 31),
             load_date=dt.date(2024, 12, 31), budget_min_year=2024, history_cut=dt.date(2024, 3, 1),
             report_cost_centre="Financeiro", report_start=dt.date(2024, 2, 1), report_end=dt.date(2024, 2, 20),
             as_of=dt.date(2024, 3, 15))


@pytest.fixture(scope="module")
def sv(spark):
    ledger = []
    n = 0
    for m in (1, 2, 3):
        for d in (1, 2, 5, 9, 17, 28):
            for cc in ("1", "2", "999"):
                n += 1
                status = "PAGO" if n % 3 else "Pending"
                ledger.append((str(n), f"2024-{m:02d}-{d:02d}", cc, "101" if n % 2 else "102", "7",
                               "1.0" if n % 4 else None, f"{(n * 37) % 500 + 1}.25", status))
    ledger.append(("999", None, "1", "101.0", "7", None, "10.00", "Pago"))         # null date -> dropped
    stg = {
        "stg_lancamentos": spark.createDataFrame(ledger, S.STG_LANCAMENTOS),
        "stg_orcamento": spark.createDataFrame(
            [(str(i), "2024", str(m), cc, cat, "100.00") for i, (m, cc, cat) in enumerate(
                [(m, cc, cat) for m in (1, 2, 3) for cc in ("1", "2") for cat in ("101", "102")])],
            S.STG_ORCAMENTO),
        "stg_dim_centro_custo": spark.createDataFrame([("1", "FINANCEIRO"), ("2", " Vendas")], S.STG_CENTRO_CUSTO),
        "stg_dim_categoria": spark.createDataFrame([("101.0", "1.0", "A"), ("102.0", "2.0", "B")], S.STG_CATEGORIA),
        "stg_dim_fornecedores": spark.createDataFrame([("7", "S")], S.STG_FORNECEDORES),
        "stg_dim_campanha": spark.createDataFrame([("1", "C", "5")], S.STG_CAMPANHA),
    }
    return silver_plan.Silver(spark, stg, CFG)


def test_orphan_cost_centre_goes_to_default_member(sv):
    ccs = {r[0] for r in sv.fact_lancamentos.select("id_centro_custo").distinct().collect()}
    assert ccs == {1, 2, S.DEFAULT_MEMBER_ID}
    assert sv.fact_lancamentos.count() == 54                    # the null-date entry is gone


def test_mid_month_cut_equals_filtering_whole_months(sv):
    mid = CFG.with_(history_cut=dt.date(2024, 2, 10))
    got = gold.mtd_history(sv, mid)
    full = gold.mtd_history(sv, CFG.with_(history_cut=dt.date(2024, 3, 1)))
    want = full.filter(F.col("data_lancamento") < F.lit(dt.date(2024, 2, 10)))
    cols = ["data_lancamento", "id_centro_custo", "id_categoria", "gasto_mtd", "total_do_mes", "perc_gasto_mes"]
    assert rows(got, *cols) == rows(want, *cols)
    # February's month total still counts the days after the cut
    feb = got.filter(F.month("data_lancamento") == 2).agg(F.max("total_do_mes")).first()[0]
    assert feb > got.filter(F.month("data_lancamento") == 2).agg(F.max("gasto_mtd")).first()[0]


def test_report_matches_full_running_total(sv):
    rep = {r["dia"]: (r["valor"], r["gastos_mtd_cc_cat"]) for r in gold.mtd_report(sv, CFG).collect()}
    full = gold.gold_lancamentos(sv)
    f = full.filter((F.col("centro_de_custo") == "Financeiro") & (F.col("status_pagamento") == "Pago")
                    & F.col("data_lancamento").between(F.lit(CFG.report_start), F.lit(CFG.report_end)))
    want = {r["dia"]: (r["v"], r["m"]) for r in f.groupBy(F.dayofmonth("data_lancamento").alias("dia"))
            .agg(F.sum("valor").alias("v"), F.sum("gasto_mtd_cc_cat").alias("m")).collect()}
    assert rep.keys() == want.keys() and all(abs(rep[k][0] - want[k][0]) < 1e-6 and abs(rep[k][1] - want[k][1]) < 1e-6
                                             for k in rep)
    assert rep                                                  # the case-insensitive name matched


def test_gold_ledger_does_not_depend_on_the_block_size(sv):
    assert rows(gold.gold_lancamentos(sv, block=2)) == rows(gold.gold_lancamentos(sv))


def test_early_entries_stay_in_every_view(sv, spark):
    """Entries of 1993, far outside the configured calendar, reach the monthly view, the grids and the calendar."""
    early = [("5001", "1993-03-04", "1", "101", "7", None, "70.00", "Pago"), ("5002", "1993-11-30", "999", "102", "7", None, "5.50", "Pago")]
    stg = {**sv.stg, "stg_lancamentos": sv.stg["stg_lancamentos"].unionByName(spark.createDataFrame(early, S.STG_LANCAMENTOS))}
    old = silver_plan.Silver(spark, stg, CFG)
    total = float(old.fact_lancamentos.agg(F.sum("valor")).first()[0])
    assert abs(total - float(sv.fact_lancamentos.agg(F.sum("valor")).first()[0]) - 75.5) < 1e-6
    assert abs(gold.gold_realizado(old).agg(F.sum("realizado")).first()[0] - total) < 1e-6
    assert abs(float(gold.daily_grid(old).agg(F.sum("total_do_dia")).first()[0]) - total) < 1e-6
    assert gold.gold_lancamentos_diarios(old).agg(F.min("data_lancamento")).first()[0] == dt.date(1993, 1, 1)
    span = old.dim_calendario.agg(F.min("data"), F.max("data")).first()
    assert (span[0], span[1]) == (dt.date(1993, 1, 1), dt.date(2024, 12, 31))


def test_bad_rows_never_change_the_ledger(sv, spark):
    """Repeated ids, a doubled dimension and a dimension key that is no number leave the gold ledger as it is."""
    want = rows(gold.gold_lancamentos(sv))
    def with_rows(table, *more):
        return {**sv.stg, table: sv.stg[table].unionByName(spark.createDataFrame(list(more), sv.stg[table].schema))}
    repeated = sv.stg["stg_lancamentos"].limit(20)
    cases = [
        {**sv.stg, "stg_lancamentos": sv.stg["stg_lancamentos"].unionByName(repeated)},
        with_rows("stg_dim_fornecedores", ("7", "S"), ("7", "Z")),
        with_rows("stg_dim_centro_custo", ("x", "Bad"), (None, "Null")),
        with_rows("stg_dim_categoria", (None, "1.0", "A"), ("103.0", "55.0", "No such centre")),
    ]
    for stg in cases:
        bad = silver_plan.Silver(spark, stg, CFG)
        assert rows(gold.gold_lancamentos(bad)) == want
    assert silver_plan.Silver(spark, cases[0], CFG).rejects_lancamentos.filter("array_contains(regras_violadas, 'id_lancamento_unique')").count() \
        + sv.rejects_lancamentos.count() >= 19
    assert silver_plan.Silver(spark, cases[1], CFG).dimension_rejects("dim_fornecedores").count() == 2
    assert silver_plan.Silver(spark, cases[2], CFG).dimension_rejects("dim_centro_custo").count() == 2
    broken = silver_plan.Silver(spark, cases[3], CFG).dimension_rejects("dim_categoria")
    assert sorted(x for r in broken.collect() for x in r["regras_violadas"]) == ["fk_id_cc", "id_categoria_not_null"]


def test_planning_a_query_runs_no_ledger_action(sv, spark):
    spark.sparkContext.setJobGroup("build", "build")
    try:
        sv.fact_lancamentos                         # dimension sizes are checked once
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("build"))
        gold.gold_lancamentos(sv)
        gold.gold_referencia_mtd(sv, CFG)
        gold.gold_lancamentos_diarios(sv)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("build")) == before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_anti_join_with_null_parent_key_reports_nothing(spark):
    child = spark.createDataFrame([(1,), (5,)], "k int")
    parent = spark.createDataFrame([(1,), (None,)], "k2 int")
    assert anti_join(child, parent, "k", "k2").count() == 0


def test_empty_grid_and_unknown_rule(spark):
    combos = spark.createDataFrame([("a",)], "cc string")
    for span in ((dt.date(2024, 1, 2), dt.date(2024, 1, 1)), (None, None)):
        assert grid.dense_grid(combos, spark.createDataFrame([span], "inicio date, fim date"), "d").count() == 0
    df = spark.createDataFrame([(1, None)], "id int, v int")
    valid, rejects = rules.split(df, {"v_positive": F.col("v") > 0})
    assert valid.count() == 1 and rejects.count() == 0         # NULL rule result passes, like a CHECK


def test_generated_calendar_passes_its_rules(spark):
    from ledgerlight.operators import calendar
    cal = calendar.dim_calendario(spark, CFG.calendar_start, CFG.calendar_end)
    counts = dict(rows(rules.rule_counts(cal, silver_plan.calendar_rules(CFG))))
    assert set(counts.values()) == {0} and "dia_range" in counts
    mon = dict(rows(rules.rule_counts(calendar.dim_mes(cal), silver_plan.month_rules(CFG))))
    assert set(mon.values()) == {0}
    bad = spark.createDataFrame([(dt.date(2024, 1, 1),)], "data date")
    broken = calendar.calendar_attributes(bad).withColumn("dia", F.lit(40))
    assert dict(rows(rules.rule_counts(broken, silver_plan.calendar_rules(CFG))))["dia_range"] == 1
