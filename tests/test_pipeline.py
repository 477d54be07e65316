"""End-to-end medallion run from raw CSV files; a second run gives the same tables."""

import os
import tempfile

import pytest

from conftest import SMOKE_DIR
from ledgerlight.plans import pipeline
from ledgerlight.plans.config import TESTDATA
from ledgerlight.plans.registry import silver, staging
from ledgerlight.sources import files


@pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="test data not present")
def test_pipeline_from_raw_csv_is_idempotent(spark):
    base = tempfile.mkdtemp(prefix="ll-pipe-")
    raw = f"{base}/raw"
    for stg, name in pipeline.RAW_FILES.items():                 # land the raw files
        files.write_csv(staging(spark, SMOKE_DIR)[stg], f"{raw}/{name}")
    r1 = pipeline.run(spark, raw, f"{base}/out", TESTDATA)
    c1 = {r["tabela"]: r["total_registros"] for r in r1.counts.collect()}
    expected = silver(spark, SMOKE_DIR)
    assert c1["fact_lancamentos"] == expected.fact_lancamentos.count()
    assert c1["fact_orcamento"] == expected.fact_orcamento.count()
    r2 = pipeline.run(spark, raw, f"{base}/out", TESTDATA)
    c2 = {r["tabela"]: r["total_registros"] for r in r2.counts.collect()}
    assert c1 == c2
    g = files.read_table(spark, r2.paths["gold_realizado"])
    assert g.count() == files.read_table(spark, r1.paths["gold_realizado"]).count()
    assert files.read_table(spark, r2.paths["m21_ritmo_diario"]).count() == 31        # days of the as-of month
    prof = files.read_table(spark, f"{base}/out/quality/profile")
    assert prof.filter("regra = 'linhas' AND tabela = 'stg_lancamentos'").first()["qtd"] == \
        staging(spark, SMOKE_DIR)["stg_lancamentos"].count()
