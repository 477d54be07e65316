"""Grids in step form against the dense grid, day by day."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from ledgerlight.operators import benchmark, calendar, grid, steps

KEYS = ["cc", "cat"]


def _daily(spark, seed=5, entries=160):
    rnd = random.Random(seed)
    data = {}
    for _ in range(entries):
        day = dt.date(2023, 11, 1) + dt.timedelta(days=rnd.randrange(190))
        cc = 1 if rnd.random() < 0.5 else rnd.choice([2, 3, None])
        key = (day, cc, rnd.randint(1, 3))
        data[key] = data.get(key, 0) + rnd.randint(1, 5000)
    return spark.createDataFrame([(*k, v) for k, v in data.items()], "data date, cc int, cat int, v int") \
                .select("data", "cc", "cat", (F.col("v") / 100).cast("decimal(16,2)").alias("v"))


def _dense(daily, span):
    """The grid by joins and windows over every day."""
    g = grid.fill_grid(grid.dense_grid(daily.select(*KEYS).distinct(), span, "data"), daily, [(c, c) for c in ("data", *KEYS)], "v", "total_do_dia")
    month = Window.partitionBy("ano", "mes", *KEYS)
    return (g.withColumn("gasto_mtd", F.sum("total_do_dia").over(month.orderBy("data").rowsBetween(Window.unboundedPreceding, 0)))
             .withColumn("total_do_mes", F.sum("total_do_dia").over(month)))


COLS = ["data", "cc", "cat", "dia", "total_do_dia", "gasto_mtd", "total_do_mes"]


def test_spelled_days_equal_the_dense_grid(spark):
    daily = _daily(spark)
    span = calendar.covering_years(daily, "data")
    months = steps.member_months(daily, "data", KEYS, "v")
    got = steps.spelled(months, daily.select(*KEYS).distinct(), span, KEYS, "data")
    assert rows(got, *COLS) == rows(_dense(daily, span), *COLS)
    assert dict(got.dtypes)["gasto_mtd"] == "decimal(26,2)"
    cut = span.select("inicio", F.lit(dt.date(2024, 2, 10)).alias("fim"))
    assert rows(steps.spelled(months, daily.select(*KEYS).distinct(), cut, KEYS, "data"), *COLS) == \
        rows(_dense(daily, span).filter("data <= DATE'2024-02-10'"), *COLS)
    assert steps.spelled(months.limit(0), daily.select(*KEYS).limit(0), calendar.covering_years(daily.limit(0), "data"), KEYS, "data").count() == 0


@pytest.mark.parametrize("cut,bits,sets,days", [(None, 12, None, None), (dt.date(2024, 3, 18), 12, None, None), (dt.date(2024, 2, 1), 0, None, None),
                                                (None, 12, [["cc"], []], [1, 30, 31]), (dt.date(2024, 4, 2), 3, [["cc", "cat"]], [29])])
def test_step_medians_equal_medians_of_the_dense_grid(spark, cut, bits, sets, days):
    daily = _daily(spark, seed=bits)
    span = calendar.covering_years(daily, "data")
    share = F.try_divide(F.col("gasto_mtd").cast("double"), F.nullif("total_do_mes", F.lit(0)).cast("double"))
    dense = _dense(daily, span).withColumn("share", share)
    found = steps.steps(steps.member_months(daily, "data", KEYS, "v"), KEYS)
    if cut:
        dense, found = dense.filter(F.col("data") < F.lit(cut)), steps.before(found, cut)
    values = {"p": "share", "m": "gasto_mtd"}
    want = benchmark.multi_grain_median(dense.filter(F.col("dia").isin(*days)) if days else dense, "dia", KEYS, values, sets=sets)
    cells = steps.cells(daily.select(*KEYS).distinct(), span, KEYS, cut)
    weighted = steps.weighted_days(found, cells, KEYS, days).withColumn("share", share)
    got = benchmark.multi_grain_median(weighted, "dia", KEYS, values, sets=sets, bits=bits, weight="celulas")
    assert weighted.agg(F.sum("celulas")).first()[0] == (dense.filter(F.col("dia").isin(*days)) if days else dense).count()
    assert rows(got, "dia", *KEYS, "p", "m") == rows(want, "dia", *KEYS, "p", "m")


def test_steps_are_as_many_as_bookings(spark):
    daily = _daily(spark)
    months = steps.member_months(daily, "data", KEYS, "v")
    found = steps.steps(months, KEYS).collect()
    booked = daily.filter("cc IS NOT NULL").count()
    assert booked <= len(found) <= booked + months.count()
    assert all(r["de"] < r["ate"] <= 32 for r in found)
    per = {}
    for r in found:
        per.setdefault((r["cc"], r["cat"], r["ano"], r["mes"]), []).append(r["ate"] - r["de"])
    assert all(sum(v) == (dt.date(k[2] + k[3] // 12, k[3] % 12 + 1, 1) - dt.date(k[2], k[3], 1)).days for k, v in per.items())
