"""Property tests: period changes and deviation bands vs brute force."""

from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlight import schemas as S
from ledgerlight.operators import periods, quality

months = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 26),
                            st.sampled_from([0, 5, 10, 20, 35])), min_size=1, max_size=30)


def _brute(rows, offset, mode):
    series = {}
    for m, idx, v in rows:
        series.setdefault(m, {})[idx] = v
    out = {}
    for m, by_idx in series.items():
        order = sorted(by_idx)
        for pos, idx in enumerate(order):
            if mode == "rows":
                prev = by_idx[order[pos - offset]] if pos >= offset else None
            else:
                prev = by_idx.get(idx - offset)
            v = by_idx[idx]
            ab = None if prev in (None, 0) else float(v - prev)
            pct = None if prev in (None, 0) else round(v / prev - 1, 6)
            out[(m, idx)] = (ab, pct)
    return out


@settings(max_examples=12, deadline=None)
@given(months, st.sampled_from([1, 12]), st.sampled_from(["rows", "calendar"]))
def test_period_change_matches_brute_force(spark, rows, offset, mode):
    uniq = {(m, i): v for m, i, v in rows}                 # one value per member and month
    rows = [(m, i, v) for (m, i), v in uniq.items()]
    df = spark.createDataFrame([(m, 2020 + i // 12, i % 12 + 1, Decimal(v)) for m, i, v in rows],
                               "cc string, ano int, mes int, v decimal(18,2)")
    got = periods.period_change(df, "v", ["cc"], "ano", "mes", offset, "ab", "pct", mode=mode)
    res = {(r["cc"], (r["ano"] - 2020) * 12 + r["mes"] - 1): (r["ab"], r["pct"]) for r in got.collect()}
    assert res == _brute(rows, offset, mode)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["g", "h"]), st.integers(1, 400)), min_size=1, max_size=40))
def test_deviation_bands_match_brute_force(spark, vals):
    df = spark.createDataFrame([(g, Decimal(v)) for g, v in vals], "g string, v decimal(18,2)")
    got = {r["faixa_nome"]: (r["valor_concentrado"], r["registros"])
           for r in quality.deviation_bands(df, F.col("v"), ["g"]).collect()}
    sums = {}
    for g, v in vals:
        sums.setdefault(g, []).append(v)
    want = {name: [0.0, 0] for name, _, _ in S.DEVIATION_BANDS}
    for g, v in vals:
        r = v / (float(sum(sums[g])) / len(sums[g])) - 1
        for name, lo, hi in S.DEVIATION_BANDS:
            ok = (r > lo) if hi is None else ((r < hi) if lo is None else (lo <= r <= hi))
            if ok:
                want[name][0] += v
                want[name][1] += 1
                break
    assert got == {k: (float(a), b) for k, (a, b) in want.items()}
