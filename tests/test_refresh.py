"""A late file rewrites only the months it changes, and the result equals the full load."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_DIR, rows
from ledgerlight.plans import load, refresh
from ledgerlight.plans.config import TESTDATA
from ledgerlight.plans.registry import staging
from ledgerlight.sources.snapshots import Conflict

pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="test data not present")


def _kept(spark, ledger):
    stg = {**dict(staging(spark, SMOKE_DIR)), "stg_lancamentos": ledger}
    return load.KeptSilver(spark, stg, TESTDATA, tempfile.mkdtemp(prefix="ll-refresh-"))


def _everything(sv):
    return {**{n: rows(refresh.read(sv, n)) for n in (*refresh.OF_MONTH, *refresh.ACROSS)},
            "fact": rows(sv.fact_lancamentos), "months": rows(sv.monthly_totals), "span": rows(sv.calendar_span),
            "rejects": sorted(map(str, sv.rejects_lancamentos.collect()))}


def _months(sv):
    return {(r["ano"], r["mes"]) for r in refresh.read(sv, "gold_realizado").select("ano", "mes").distinct().collect()}


def test_one_late_file_equals_the_full_load(spark):
    whole = staging(spark, SMOKE_DIR)["stg_lancamentos"].checkpoint()
    day = F.col("data_lancamento")
    # the late file: entries of two months, a repeat with a smaller row, one with a larger row, a broken row
    is_late = day.startswith("1997-03") | (day.startswith("1999-11") & (F.col("id_lancamento").cast("long") % 3 == 0))
    stays = whole.filter(~F.coalesce(is_late, F.lit(False)))
    seen = stays.filter(day.startswith("1996-05") & (F.col("id_lancamento").cast("long") % 101 != 0) & (F.col("valor_lancamento").cast("double") > 0)).orderBy("id_lancamento").limit(2).collect()
    def other(r, **kw):
        return tuple({**r.asDict(), **kw}[c] for c in whole.columns)
    extra = spark.createDataFrame([other(seen[0], data_lancamento="1995-02-03"), other(seen[1], data_lancamento="2000-01-01"),
                                   other(seen[1], id_lancamento="x")], whole.schema)
    late = whole.filter(is_late).unionByName(extra)

    first = refresh.build(_kept(spark, stays))
    before = first.store.latest()
    change = refresh.add_entries(first, late)
    full = refresh.build(_kept(spark, stays.unionByName(late)))
    assert _everything(change.silver) == _everything(full)

    assert change.touched == [(1995, 2), (1996, 5), (1997, 3), (1999, 11)]
    assert change.rewritten["gold_lancamentos"] == change.touched
    across = set(change.rewritten["gold_realizado"])
    assert set(change.touched) <= across and len({m for m in across if m[0] == 1997}) > 8          # to-date totals and means of the year
    assert len(across) < len(_months(full))
    after = change.silver.store.latest()
    assert after["version"] == before["version"] + 1
    for name in ("fact_lancamentos", "gold_lancamentos", "gold_realizado"):       # the other months keep their folder
        assert after["tables"][name]["folders"][0]["path"] == before["tables"][name]["folders"][0]["path"]

    # the same file again: all of it is repeats now, no month is touched
    again = refresh.add_entries(change.silver, whole.filter(is_late))
    assert again.touched == [] and again.rewritten == {} and rows(again.silver.fact_lancamentos) == rows(full.fact_lancamentos)
    assert refresh.add_entries(again.silver, late.limit(0)).touched == []


def test_a_crash_before_publication_changes_nothing(spark, monkeypatch):
    whole = staging(spark, SMOKE_DIR)["stg_lancamentos"].checkpoint()
    late = F.coalesce(F.col("data_lancamento").startswith("1998-0"), F.lit(False))
    sv = refresh.build(_kept(spark, whole.filter(~late)), ["gold_realizado"])
    old = rows(sv.fact_lancamentos)
    publish = type(sv.store).publish
    monkeypatch.setattr(type(sv.store), "publish", lambda *a, **k: (_ for _ in ()).throw(Conflict("another writer")))
    with pytest.raises(Conflict):
        refresh.add_entries(sv, whole.filter(late))
    assert rows(refresh._reader(sv).fact_lancamentos) == old
    monkeypatch.setattr(type(sv.store), "publish", publish)
    assert len(refresh.add_entries(sv, whole.filter(late)).touched) == 9
