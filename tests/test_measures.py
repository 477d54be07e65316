"""Measure helpers on hand-made frames: periods, projections, risk and pace."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from ledgerlight import schemas as S
from ledgerlight.plans import measures
from ledgerlight.plans.config import Config


def test_period_of_handles_month_lengths():
    p = measures.Period.of(Config(as_of=dt.date(2024, 2, 29)))
    assert (p.day, p.days_in_month, p.month_start) == (29, 29, dt.date(2024, 2, 1))
    assert p.as_of_ly == dt.date(2023, 2, 28)             # no Feb 29 last year


def test_projections_linear_historical_hybrid(spark):
    cfg = Config(as_of=dt.date(2024, 11, 10))             # day 10 of 30
    p = measures.Period.of(cfg)
    base = spark.createDataFrame([(1, 100.0), (2, 50.0)], "id_centro_custo int, realizado double")
    ref = spark.createDataFrame(
        [(10, 1, -999, 0.25, 0.0), (30, 1, -999, 1.0, 0.0),      # cc 1: 25 % spent by day 10
         (10, 2, -999, 0.0, 0.0), (30, 2, -999, 1.0, 0.0)],      # cc 2: no weight yet -> linear only
        "dia int, id_centro_custo int, id_categoria int, peso_do_dia double, valor_mediano_dia double")
    out = measures.projections(base, ref, p, cfg, True, False)
    got = {r["id_centro_custo"]: (r["__linear"], r["__hist"], r["__final"]) for r in out.collect()}
    lin1, hist1, fin1 = got[1]
    assert lin1 == 300.0 and hist1 == 400.0 and abs(fin1 - (0.3 * 300 + 0.7 * 400)) < 1e-9
    assert got[2][1] is None and got[2][2] == got[2][0] == 150.0


def test_risk_light_and_pace(spark):
    df = spark.createDataFrame([(1, 120.0, 100.0), (2, 85.0, 100.0), (3, 10.0, 100.0), (4, 5.0, None)],
                               "k int, a double, b double")
    out = df.select("k", measures.risk_light(F.col("a"), F.col("b"), 0.8).alias("r"),
                    measures.pace_status(F.col("a"), F.col("b"), 0.1).alias("p"))
    assert rows(out) == [(1, S.RISK_RED, S.PACE_OVER), (2, S.RISK_AMBER, S.PACE_UNDER),
                         (3, S.RISK_GREEN, S.PACE_UNDER), (4, S.RISK_RED, S.PACE_OVER)]


def test_with_scalars_attaches_one_row(spark):
    df = spark.range(5)
    one = spark.range(10).agg(F.sum("id").alias("total"))
    assert [r["total"] for r in measures.with_scalars(df, one).collect()] == [45] * 5
