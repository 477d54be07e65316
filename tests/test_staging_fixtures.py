"""The test-data staging reproduces the expected defect counts (FIXTURES.md §3) at sf0.01."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerlight import schemas as S
from ledgerlight.operators import rules
from ledgerlight.plans.registry import silver, staging

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_staging_defects_match_fixture_counts(spark):
    stg = staging(spark, SF)
    every = stg["stg_lancamentos"]
    assert (every.count(), stg["stg_orcamento"].count(), stg["stg_dim_centro_custo"].count(), stg["stg_dim_fornecedores"].count()) == (15149, 8497, 28, 115)
    lanc, repeats = rules.keep_first(every, ["id_lancamento"])          # the planted repeats are apart
    assert repeats.count() == 149
    c = lanc.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id_lancamento").alias("ids"),
                 F.count_if(F.col("data_lancamento").isNull()).alias("null_dates"),
                 F.count_if(F.col("valor_lancamento").startswith("-")).alias("negatives"),
                 F.count_if(F.col("id_fornecedor").isNull()).alias("null_supplier"),
                 F.count_if(F.col("id_campanha_marketing").isNull()).alias("null_campaign")).first()
    assert (c.n, c.ids, c.null_dates, c.negatives, c.null_supplier, c.null_campaign) == \
        (15000, 15000, 155, 169, 257, 3020)
    statuses = {r[0]: r[1] for r in lanc.groupBy("status_pagamento").count().collect()}
    assert statuses == {"Aberto": 2531, "PAGO": 1626, "Paga": 1662, "Pago": 6733, "Pending": 2448}
    sv = silver(spark, SF)
    known = sv.dim_centro_custo.select(F.col("id_cc").cast("string").alias("k"))
    assert lanc.join(known, lanc.id_centro_custo == known.k, "left_anti").count() == 2960
    assert sv.fact_orcamento.count() == 8173
    assert sv.fact_orcamento.filter(F.col("status_dado") == S.BUDGET_SUSPECT).count() == 138
    assert [getattr(sv, t).count() for t in ("dim_centro_custo", "dim_categoria", "dim_fornecedores", "dim_camp_marketing")] == [21, 5, 100, 4]
    # the 257 rows without supplier (and their repeats) break NOT NULL; the other repeats break the key
    broken = {r[0]: r[1] for r in sv.rejects_lancamentos.groupBy(F.concat_ws(",", "regras_violadas")).count().collect()}
    assert broken.keys() == {"id_fornecedor_not_null", "id_lancamento_unique"}
    assert sum(broken.values()) == sv.vw_lancamentos.count() - sv.fact_lancamentos.count()
