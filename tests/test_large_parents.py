"""Foreign keys whose parent is beyond a broadcast: only distinct keys are looked up, rows are not shuffled."""

import os

import pytest
from conftest import SMOKE_DIR, rows

from pyspark.sql import functions as F

from ledgerlight.operators import cleanse, joins, quality
from ledgerlight.plans import silver as plan
from ledgerlight.plans.config import TESTDATA
from ledgerlight.plans.registry import staging


@pytest.fixture
def child(spark):
    """20,000 rows: a third under one key, NULL keys, keys from 40 to 44 (42 falls to the hot one) and the hot 99 not in the parent."""
    key = F.when(F.col("id") % 3 == 0, 99).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 45)
    return spark.range(20_000).select("id", key.cast("int").alias("k"))


@pytest.fixture
def parent(spark):
    return spark.range(40).selectExpr("CAST(id AS INT) AS p").union(spark.range(3).selectExpr("CAST(id AS INT)"))


def test_absent_keys_are_the_probe(spark, child, parent):
    gone = joins.absent_keys(child, "k", parent, "p")
    assert rows(gone) == [(40,), (41,), (43,), (44,), (99,)]


@pytest.mark.parametrize("limit", [1, 10, 1000])                 # all joins shuffled; absent keys broadcast; parent broadcast
def test_flags_do_not_depend_on_the_parents_size(spark, child, parent, limit):
    known = {r["p"] for r in parent.collect()}
    want = sorted((r["id"], r["k"] is not None and r["k"] not in known) for r in child.collect())
    flagged = joins.with_missing(child, "k", parent, "p", "lost", max_rows=limit)
    assert flagged.columns == ["id", "k", "lost"]
    assert sorted((r["id"], r["lost"]) for r in flagged.collect()) == want
    orphans = joins.anti_join(child, parent, "k", "p", max_rows=limit)
    assert sorted(r["id"] for r in orphans.collect()) == [i for i, lost in want if lost]
    with_null = parent.union(spark.sql("SELECT CAST(NULL AS INT)"))
    assert joins.anti_join(child, with_null, "k", "p", max_rows=limit).count() == 0
    assert sorted((r["id"], r["lost"]) for r in joins.with_missing(child, "k", with_null, "p", "lost", max_rows=limit).collect()) == want


def test_rows_are_not_shuffled(spark, child, parent):
    text = joins.with_missing(child, "k", parent, "p", "lost", max_rows=10)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    empty = parent.limit(0)
    assert joins.with_missing(child, "k", empty, "p", "lost", max_rows=10).filter("lost").count() == child.filter("k IS NOT NULL").count()
    assert joins.with_missing(child.limit(0), "k", parent, "p", "lost", max_rows=10).count() == 0


def test_operators_on_large_parents(spark, child, parent, monkeypatch):
    def results():
        return (rows(cleanse.rekey_unknown(child, "k", parent, "p")),
                rows(quality.fk_violations(child, {"a": ("k", parent, "p"), "b": (F.col("k") + 1, parent, "p")})),
                rows(quality.orphan_keys(child, "k", parent, "p")))
    small = results()
    monkeypatch.setattr(joins, "fits", lambda df, max_rows=0: False)
    assert results() == small


@pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="test data not present")
def test_silver_on_large_dimensions(spark, monkeypatch):
    stg = staging(spark, SMOKE_DIR)
    small = plan.build(spark, stg, TESTDATA)
    want, rejects = rows(small.fact_lancamentos), small.rejects_lancamentos.count()
    monkeypatch.setattr(joins, "fits", lambda df, max_rows=0: False)
    large = plan.build(spark, stg, TESTDATA)
    assert rows(large.fact_lancamentos) == want and large.rejects_lancamentos.count() == rejects
