"""Medians from kept counts against medians of the dense grid, and the counts of months."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_DIR, rows
from ledgerlight.operators import benchmark, calendar, median_state, steps
from ledgerlight.plans import gold, load, refresh
from ledgerlight.plans.config import TESTDATA
from ledgerlight.plans.registry import staging
from test_steps import KEYS, _daily, _dense

VALUES = {"p": "share", "m": "gasto_mtd"}


def _share():
    return F.try_divide(F.col("gasto_mtd").cast("double"), F.nullif("total_do_mes", F.lit(0)).cast("double"))


def _found(daily):
    return steps.steps(steps.member_months(daily, "data", KEYS, "v"), KEYS).withColumn("share", _share())


@pytest.mark.parametrize("cut,bits,sets,days", [
    (dt.date(2025, 1, 1), 12, None, None), (dt.date(2024, 3, 18), 12, None, None), (dt.date(2024, 2, 1), 0, None, None),
    (dt.date(2024, 4, 2), 3, [["cc"], []], [1, 30, 31]), (dt.date(2024, 2, 29), 12, [["cat"]], [28, 29]), (dt.date(2023, 1, 1), 12, None, None)])
def test_medians_from_the_state_equal_medians_of_the_dense_grid(spark, cut, bits, sets, days):
    daily = _daily(spark, seed=bits)
    # a month whose bookings cancel out has no shares
    daily = daily.unionByName(spark.createDataFrame([(dt.date(2024, 7, 3), 9, 9, 5.0), (dt.date(2024, 7, 5), 9, 9, -5.0)], "data date, cc int, cat int, v double")
                              .withColumn("v", F.col("v").cast("decimal(16,2)")))
    span = calendar.covering_years(daily, "data")
    sets = sets or median_state.merged_sets(KEYS)
    dense = _dense(daily, span).withColumn("share", _share()).filter(F.col("data") < F.lit(cut))
    want = benchmark.multi_grain_median(dense.filter(F.col("dia").isin(*days)) if days else dense, "dia", KEYS, VALUES, sets=sets)
    found = _found(daily)
    state = median_state.month_ranges(found, KEYS, VALUES, bits)
    cells = median_state.all_cells(daily.select(*KEYS).distinct(), span, KEYS, sets, cut, days)
    got = median_state.medians(median_state.before(state, cut), steps.before(found, cut), cells, KEYS, VALUES, "m", sets, days, bits)
    assert rows(got, "dia", *KEYS, "p", "m") == rows(want, "dia", *KEYS, "p", "m")


def test_the_state_of_months_is_the_union_of_their_states(spark):
    daily = _daily(spark)
    found = _found(daily)
    first = F.col("ano") * 12 + F.col("mes") < 2024 * 12 + 2
    parts = [median_state.month_ranges(found.filter(c), KEYS, VALUES) for c in (first, ~first)]
    assert rows(parts[0].unionByName(parts[1])) == rows(median_state.month_ranges(found, KEYS, VALUES))
    counted = median_state.month_ranges(found, KEYS, VALUES).filter("nome = 'm'").groupBy("grao").agg(F.sum("n").alias("n")).collect()
    days = found.agg(F.sum(F.col("ate") - F.col("de"))).first()[0]
    assert {r["n"] for r in counted} == {days} and len(counted) == 3


def test_empty_state(spark):
    daily = _daily(spark).limit(0)
    found = _found(daily)
    cells = median_state.all_cells(daily.select(*KEYS), calendar.covering_years(daily, "data"), KEYS, [[]])
    assert median_state.medians(median_state.month_ranges(found, KEYS, VALUES), found, cells, KEYS, VALUES, "m", [[]]).count() == 0


@pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="test data not present")
def test_a_late_file_replaces_the_counts_of_its_months(spark):
    whole = staging(spark, SMOKE_DIR)["stg_lancamentos"].checkpoint()
    late = F.coalesce(F.col("data_lancamento").startswith("1997-03"), F.lit(False))

    def kept(ledger):
        return load.KeptSilver(spark, {**dict(staging(spark, SMOKE_DIR)), "stg_lancamentos": ledger}, TESTDATA, tempfile.mkdtemp(prefix="ll-state-"))

    old = refresh.build(kept(whole.filter(~late)), [])
    before = rows(old.median_ranges)
    change = refresh.add_entries(old, whole.filter(late))
    full = kept(whole)
    assert rows(change.silver.median_ranges) == rows(full.median_ranges) != before
    assert change.rewritten["median_ranges"] == [(1997, 3)]
    view = gold.gold_referencia_mtd(change.silver, TESTDATA)
    assert rows(view) == rows(gold.gold_referencia_mtd(full, TESTDATA, bits=2))         # counted anew, without the state
    plan = gold.gold_referencia_mtd(full, TESTDATA, sets=[[]])._jdf.queryExecution().optimizedPlan().toString()
    assert any("median_ranges" in f for f in gold.gold_referencia_mtd(full, TESTDATA, sets=[[]]).inputFiles()) and "fact_lancamentos" not in plan
