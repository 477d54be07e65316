"""Running totals, period metrics, grids and medians vs brute force."""

import datetime as dt
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerlight.operators import benchmark, calendar, grid, periods, ranking
from ledgerlight.operators.running import running_sum


def _brute_running(data, gkey, okey):
    out, acc = {}, {}
    for r in sorted(data, key=lambda r: (str(gkey(r)), okey(r))):
        g = gkey(r)
        acc[g] = acc.get(g, 0) + r[3]
        out[r[0]] = acc[g]
    return out


@pytest.mark.parametrize("block", [1, 7, 100, 65536])
def test_running_sum_matches_brute_force(spark, block):
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        g = None if i % 17 == 0 else ("hot" if i % 3 else rnd.choice("abcde"))   # one key holds 2/3
        data.append((i, g, rnd.randint(1, 3 if i % 2 else 28), rnd.randint(1, 999)))
    df = spark.createDataFrame(data, "id long, g string, d int, v long")
    out = running_sum(df, ["g"], "d", "id", "v", "rs", block=block)
    want = _brute_running(data, lambda r: r[1], lambda r: (r[2], r[0]))
    assert dict(rows(out, "id", "rs")) == want


def test_mom_gap_rows_vs_calendar(spark):
    """mom_gap: months 1, 2, 4 -> rows mode compares 4 with 2, calendar mode gives NULL."""
    df = spark.createDataFrame([(2024, 1, "cc", Decimal("10")), (2024, 2, "cc", Decimal("20")),
                                (2024, 4, "cc", Decimal("40"))], "ano int, mes int, cc string, v decimal(18,2)")
    r = periods.period_change(df, "v", ["cc"], "ano", "mes", 1, "abs", "pct", mode="rows")
    c = periods.period_change(df, "v", ["cc"], "ano", "mes", 1, "abs", "pct", mode="calendar")
    assert rows(r, "mes", "abs", "pct") == [(1, None, None), (2, 10.0, 1.0), (4, 20.0, 1.0)]
    assert rows(c, "mes", "abs", "pct") == [(1, None, None), (2, 10.0, 1.0), (4, None, None)]


def test_zero_previous_gives_null(spark):
    df = spark.createDataFrame([(2024, 1, "cc", Decimal("0")), (2024, 2, "cc", Decimal("5"))],
                               "ano int, mes int, cc string, v decimal(18,2)")
    r = periods.period_change(df, "v", ["cc"], "ano", "mes", 1, "abs", "pct")
    assert rows(r, "mes", "abs", "pct")[1] == (2, None, None)


def test_share_with_zero_total_is_null(spark):
    df = spark.createDataFrame([(1, "a", 0.0), (1, "b", 0.0), (2, "a", 1.0), (2, "b", 3.0)],
                               "mes int, cc string, v double")
    total = periods.with_month_total(df, "v", ["mes"], "t")
    out = total.select("mes", "cc", periods.share("v", ["mes", "cc"], "t").alias("s"))
    assert rows(out) == [(1, "a", None), (1, "b", None), (2, "a", 0.25), (2, "b", 0.75)]
    s2 = periods.share_of_total(df, "v", ["mes"], "s")
    assert rows(s2, "mes", "cc", "s") == [(1, "a", None), (1, "b", None), (2, "a", 0.25), (2, "b", 0.75)]


def test_calendar_shape(spark):
    cal = calendar.dim_calendario(spark, "2023-01-01", "2024-12-31")
    assert cal.count() == 731
    r = cal.filter(F.col("data") == F.lit(dt.date(2024, 11, 2))).first()
    assert r["dia_da_semana"] == "Sábado" and r["dia_util"] == "nao"
    assert (r["ano_mes"], r["semestre"], r["semestre_ano"], r["ano_semestre"]) == (202411, 2, "2/2024", 20242)
    assert (r["trimestre"], r["ano_trimestre"], r["bimestre"], r["ano_bimestre"]) == (4, 20244, 6, 20246)
    assert r["nome_do_mes"] == "Novembro" and r["mes_ano"] == "nov/24"
    assert calendar.dim_mes(cal).count() == 24


def test_dense_grid_fills_zero(spark):
    combos = spark.createDataFrame([("a", 1), ("b", 2)], "cc string, cat int")
    totals = spark.createDataFrame([(dt.date(2024, 1, 2), "a", 1, 5.0)], "d date, cc string, cat int, t double")
    span = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 3))], "inicio date, fim date")
    g = grid.dense_grid(combos, span, "d")
    f = grid.fill_grid(g, totals, [("d", "d"), ("cc", "cc"), ("cat", "cat")], "t", "t")
    got = rows(f, "d", "cc", "t")
    assert len(got) == 6 and sum(x[2] for x in got) == 5.0
    assert (dt.date(2024, 1, 2), "a", 5.0) in got


def test_median_even_skips_null_weight_keeps_zero(spark):
    """median_even: four months, one with zero total -> NULL weight skipped, zero MTD kept."""
    df = spark.createDataFrame([(1, 10, 1, 0.2, 5.0), (1, 10, 1, 0.4, 0.0), (1, 10, 1, None, 0.0),
                                (1, 10, 1, 0.6, 7.0)], "dia int, cc int, cat int, w double, mtd double")
    m = benchmark.multi_grain_median(df, "dia", ["cc", "cat"], {"p": "w", "v": "mtd"})
    got = {(r["cc"], r["cat"]): (r["p"], r["v"]) for r in m.collect()}
    assert got[(10, 1)] == (0.4, 2.5)                 # median of 0.2, 0.4, 0.6; of 0, 0, 5, 7
    assert set(got) == {(10, 1), (10, -999), (-999, 1), (-999, -999)}


def test_multi_grain_median_matches_brute_force(spark):
    rnd = random.Random(3)
    data = [(rnd.randint(1, 3), rnd.choice([1, 2, None]), rnd.randint(1, 2), float(rnd.randint(0, 50)))
            for _ in range(300)]
    df = spark.createDataFrame(data, "dia int, cc int, cat int, x double")
    m = benchmark.multi_grain_median(df, "dia", ["cc", "cat"], {"med": "x"})
    got = {(r["dia"], r["cc"], r["cat"]): r["med"] for r in m.collect()}
    groups = {}
    for dia, cc, cat, x in data:
        for key in [(dia, cc, cat), (dia, cc, -999), (dia, -999, cat), (dia, -999, -999)]:
            groups.setdefault(key, []).append(x)
    assert got == {k: statistics.median(v) for k, v in groups.items()}   # NULL cc is a real key


@pytest.mark.parametrize("bits", [0, 2, 12])
def test_median_with_ties_and_negatives_matches_brute_force(spark, bits):
    rnd = random.Random(11)
    data = []
    for i in range(1200):
        cc = None if i % 13 == 0 else (1 if i % 2 else rnd.choice([2, 3]))       # one hot member
        x = 0.0 if rnd.random() < 0.9 else rnd.choice([-1, 1]) * rnd.random() * 10 ** rnd.randint(-3, 6)   # 90 % ties
        data.append((rnd.randint(1, 2), cc, rnd.randint(1, 2), x, None if i % 7 == 0 else float(rnd.randint(-9, 9))))
    df = spark.createDataFrame(data, "dia int, cc int, cat int, x double, y double")
    m = benchmark.multi_grain_median(df, "dia", ["cc", "cat"], {"mx": "x", "my": "y"}, bits=bits)
    got = {(r["dia"], r["cc"], r["cat"]): (r["mx"], r["my"]) for r in m.collect()}
    gx, gy = {}, {}
    for dia, cc, cat, x, y in data:
        for key in [(dia, cc, cat), (dia, cc, -999), (dia, -999, cat), (dia, -999, -999)]:
            gx.setdefault(key, []).append(x)
            if y is not None:
                gy.setdefault(key, []).append(y)
    assert got.keys() == gx.keys()
    for k, v in gx.items():
        assert abs(got[k][0] - statistics.median(v)) < 1e-9 and got[k][1] == (statistics.median(gy[k]) if k in gy else None)


def test_tied_values_meet_as_one_row(spark):
    """The rows that go into a median's windows are distinct values, however many rows hold them."""
    df = spark.range(100_000).select(F.lit(1).alias("g"), F.when(F.col("id") % 10 == 0, F.col("id") % 70).otherwise(0).cast("double").alias("v"))
    plan = _plan(benchmark.group_median(df, ["g"], "v"))
    before_window = plan[plan.rindex("Window"):]
    assert "HashAggregate" in before_window
    assert benchmark.group_median(df, ["g"], "v").first()["v"] == 0.0


def test_top_k_per_group_salted_equals_plain(spark):
    rnd = random.Random(5)
    data = [(rnd.choice("aab"), i, float(rnd.randint(1, 100))) for i in range(500)]
    df = spark.createDataFrame(data, "g string, k int, v double")
    order = [F.col("v").desc(), F.col("k")]
    salted = ranking.top_k_per_group(df, ["g"], order, 5, salt_col="k", buckets=7)
    plain = ranking.top_k_per_group(df, ["g"], order, 5)
    assert rows(salted, "g", "k") == rows(plain, "g", "k")
    assert salted.count() == 10


def _plan(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()
