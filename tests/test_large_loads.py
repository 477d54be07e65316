"""Loads and views whose work and memory grow no faster than the tables: what their plans and tasks do, on small rows."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ledgerlight import schemas as S
from ledgerlight.operators import joins, rules
from ledgerlight.plans import gold, load, queries_quality
from ledgerlight.plans import silver as silver_plan
from ledgerlight.plans.config import Config
from ledgerlight.sources import testdata
from ledgerlight.streaming import ledger_stream

CFG = Config(calendar_start=dt.date(2024, 1, 1), calendar_end=dt.date(2024, 12, 31), load_date=dt.date(2024, 12, 31), budget_min_year=2024)


def _staging(spark):
    entries = [(str(n), f"2024-0{1 + n % 3}-0{1 + n % 2}", "1" if n % 5 else "9", "101", str(7 + n % 2), None, f"{n}.50", "PAGO" if n % 3 else "Pending")
               for n in range(1, 60)]
    entries += [("4", "2024-01-01", "1", "101", "7", None, "1.00", "Pago"), ("4", "2024-01-01", "1", "101", "7", None, "1.00", "Pago"),
                (None, "2024-01-01", "1", "101", "7", None, "1.00", "Pago"), ("x", "2024-01-01", "1", "101", "7", None, "1.00", "Pago"),
                ("70", "2024-01-01", "1", "404", "7", None, "1.00", "Pago"), ("71", None, "1", "101", "7", None, "1.00", "Pago")]
    budget = [(str(n), "2024", str(1 + n % 12), "1", "101", "100.00") for n in range(20)] + [("3", "2024", "4", "1", "101", "5.00"), (None, "2024", "4", "1", "101", "5.00")]
    return {"stg_lancamentos": spark.createDataFrame(entries, S.STG_LANCAMENTOS), "stg_orcamento": spark.createDataFrame(budget, S.STG_ORCAMENTO),
            "stg_dim_centro_custo": spark.createDataFrame([("1", "A")], S.STG_CENTRO_CUSTO),
            "stg_dim_categoria": spark.createDataFrame([("101.0", "1.0", "X")], "id_cat string, id_cc string, nome_cat string"),
            "stg_dim_fornecedores": spark.createDataFrame([("7", "S"), ("8", "S")], "id_forn string, nome_forn string"),
            "stg_dim_campanha": spark.createDataFrame([("1", "Urgent", "5")], "id_camp string, nome_camp string, mes_ref string")}


@pytest.fixture(scope="module")
def kept(spark):
    return load.KeptSilver(spark, _staging(spark), CFG, tempfile.mkdtemp(prefix="ll-kept-"))


def _exchanges(df, of):
    """The shuffles by ``of`` in the plan before it runs."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.splitlines() if "Exchange" in x and "Broadcast" not in x and of in x]


def test_g6_groups_entries_once(spark, kept):
    """month totals come from the entries, not from a second grouping by day, and no name is a grouping key."""
    g6 = gold.gold_lancamentos_consolidados_dia(kept)
    assert len(_exchanges(g6, "status_pagamento")) == 1
    assert not _exchanges(g6, "forn_nome")
    e = kept.fact_lancamentos
    month = {r["m"]: r["t"] for r in e.groupBy(F.month("data_lancamento").alias("m")).agg(F.sum("valor").alias("t")).collect()}
    want = e.groupBy("data_lancamento", "id_centro_custo", "id_categoria", "id_fornecedor", "status_pagamento").agg(F.sum("valor").alias("t")).collect()
    got = {(r["data_lancamento"], r["id_centro_de_custo"], r["id_categoria"], r["id_fornecedor"], r["status_pagamento"]): r for r in g6.collect()}
    assert len(got) == len(want) == g6.count()
    for r in want:
        g = got[(*r[:4], r[4].replace("Aberto", "Pendente"))]
        assert g["total_do_dia"] == float(r["t"]) and g["fornecedor"] == "S"
        assert g["participacao_no_mes"] == pytest.approx(float(r["t"]) / float(month[r[0].month]), abs=1e-6)


def test_budget_staging_shuffles_lines_once(spark, monkeypatch):
    """lines meet orders that know their cost centre already; no join of the lines by customer."""
    folder = tempfile.mkdtemp(prefix="ll-budget-")
    tables = {
        "lineitem": spark.createDataFrame([(1, 10.0, dt.date(1995, 1, 3), 1), (1, 5.5, dt.date(1995, 2, 3), 2), (2, 7.25, dt.date(1995, 1, 9), 1),
                                           (3, 9.0, dt.date(1995, 1, 9), 1), (None, 9.0, dt.date(1995, 1, 9), 1), (8, 1.0, dt.date(1995, 1, 9), 1)],
                                          "l_orderkey long, l_extendedprice double, l_shipdate date, l_suppkey long"),
        "orders": spark.createDataFrame([(1, 4), (2, 4), (3, 5), (3, 4), (7, None)], "o_orderkey long, o_custkey long"),
        "customer": spark.createDataFrame([(4, 2, "BUILDING"), (5, 3, "BUILDING"), (6, 2, None)], "c_custkey long, c_nationkey long, c_mktsegment string"),
        "nation": spark.createDataFrame([(2, "N2", 1), (3, "N3", testdata.EXCLUDED_REGION)], "n_nationkey long, n_name string, n_regionkey long")}
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")            # as with customers that are not few
    try:
        staged = testdata.stg_orcamento(spark, folder)
        assert len(_exchanges(staged, "o_custkey")) == 1 and len(_exchanges(staged, "l_orderkey")) == 1
        assert not [x for x in _exchanges(staged, "o_custkey") if "l_extendedprice" in x]
        joined = staged._jdf.queryExecution().optimizedPlan().toString().splitlines()
        first = next(i for i, x in enumerate(joined) if "Join" in x)
        assert "l_orderkey" in joined[first]                                # the outermost join is the lines' only one
        got = {(r["ano"], r["mes"], r["id_centro_custo"], r["id_categoria"]): float(r["valor_orcado"]) for r in staged.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {("1995", "1", "2", "102"): 26.25, ("1995", "2", "2", "102"): 5.5}


def test_all_rows_of_a_view_are_kept_or_rejected(spark, kept):
    """R1 reads the loaded rows, which are all rows of the views."""
    plain = silver_plan.Silver(spark, _staging(spark), CFG)
    for loaded, view in ((kept.ledger_rows, plain.vw_lancamentos), (kept.budget_rows, plain.vw_orcamento)):
        assert loaded.columns == view.columns and rows(loaded) == rows(view)
        assert all(kept.store.root in f for f in loaded.inputFiles())
    found = rows(rules.uniqueness_violations(kept.ledger_rows, ["id_lancamento"]))
    assert found == [(None, 2), (4, 3)]
    sliced = kept.replace(fact_lancamentos=kept.fact_lancamentos.limit(1))
    assert rows(sliced.ledger_rows) == rows(plain.vw_lancamentos)


ROWS = [(1, "b", 2), (1, "a", 3), (1, "a", 3), (2, None, None), (3, "x", 1), (None, "z", 1), (None, "y", 2), (4, None, 1), (4, "q", 1)]


@pytest.mark.parametrize("limit", [None, 0])
def test_only_repeated_keys_are_ranked(spark, monkeypatch, limit):
    """rows of unique keys are not sorted by key; the result is that of ``keep_first``, also where the list is not small."""
    if limit is not None:
        monkeypatch.setattr(rules, "bounded", lambda df: joins.bounded(df, limit))
    df = spark.createDataFrame(ROWS, "id long, a string, b int")
    for got, want in zip(rules.keep_first_of_few(df, ["id"], "r"), rules.keep_first(df, ["id"], "r"), strict=True):
        assert got.columns == want.columns and rows(got) == rows(want)
    both = [rows(x) for x in rules.keep_first_of_few(df.withColumn("c", F.lit(1)), ["id", "c"], "r")]
    assert both == [rows(x) for x in rules.keep_first(df.withColumn("c", F.lit(1)), ["id", "c"], "r")]
    empty = df.limit(0)
    assert [x.count() for x in rules.keep_first_of_few(empty, ["id"], "r")] == [0, 0]


def test_the_load_ranks_only_repeated_entries(spark, monkeypatch):
    seen = []
    real = rules.keep_first
    monkeypatch.setattr(rules, "keep_first", lambda df, key, rule="chave_unica": seen.append((tuple(key), df)) or real(df, key, rule))
    sv = load.KeptSilver(spark, _staging(spark), CFG, tempfile.mkdtemp(prefix="ll-kept-"))
    assert sv.fact_lancamentos.count() == 59
    ranked = [df for key, df in seen if key == ("id_lancamento",)]
    assert len(ranked) == 1 and "LeftSemi" in ranked[0]._jdf.queryExecution().optimizedPlan().toString()


def test_index_tasks_sort_a_bounded_number_of_ids(spark, monkeypatch):
    """the ids of one batch are sorted by several tasks, whole ranges each."""
    monkeypatch.setattr(ledger_stream, "IDS_OF_TASK", 50)
    monkeypatch.setattr(ledger_stream, "ID_RANGE", 20)
    out = tempfile.mkdtemp(prefix="ll-ids-")
    index = ledger_stream.LoadedIds(spark, out)
    index.add(spark.range(400).select(F.col("id").alias("id_lancamento"), F.lit(3).alias(ledger_stream.BATCH_COL)))
    ids = spark.read.parquet(index.ids)
    files = ids.groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.floor(F.col("id_lancamento") / 20)).alias("r")).collect()
    assert len(files) > 3 and max(r["n"] for r in files) < 400 and sum(r["r"] for r in files) == 20
    asked = spark.createDataFrame([(390,), (1000,)], "id_lancamento long")
    assert rows(index.among(asked, 4).filter("id_lancamento = 390")) == [(390,)]
    index.add(spark.range(2).select(F.col("id").alias("id_lancamento"), F.lit(3).alias(ledger_stream.BATCH_COL)))     # replayed: replaced
    assert rows(spark.read.parquet(index.ids), "id_lancamento") == [(0,), (1,)]


def test_landed_files_follow_the_input(spark, monkeypatch):
    """more input is landed as more files, not more than a trigger takes."""
    raw = spark.range(1000)
    for size, files in ((0, 4), (10 * queries_quality.LANDED_BYTES, 14), (10**15, ledger_stream.FILES_PER_TRIGGER)):
        monkeypatch.setattr(queries_quality, "input_bytes", lambda spark, paths, size=size: size)
        parts = queries_quality._as_files(spark, "/nowhere", raw, ledger_stream.FILES_PER_TRIGGER)
        assert parts.rdd.getNumPartitions() == files and parts.count() == 1000
