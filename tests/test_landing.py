"""Staging tables are landed, profiled and freed of broken lines in one reading of the raw files."""

import os
import tempfile

import pytest
from conftest import SMOKE_DIR, rows

from ledgerlight import schemas as S
from ledgerlight.operators import quality
from ledgerlight.plans import pipeline
from ledgerlight.plans.registry import staging
from ledgerlight.sources import files

TEXT = "id_cc,nome_cc\n1, marketing \n2,\n3,TI,surplus\n4\n\n5,vendas\n5,\"open\n"


def _raw(text=TEXT):
    path = os.path.join(tempfile.mkdtemp(prefix="ll-land-"), "a.csv")
    with open(path, "w") as f:
        f.write(text)
    return path


def test_landed_tables_equal_two_readings(spark):
    path = _raw()
    root = tempfile.mkdtemp(prefix="ll-landed-")
    landed = pipeline.land(spark, {"stg": files.raw_lines(spark, path, S.STG_CENTRO_CUSTO)}, root)
    good, bad = files.ingest_csv(spark, path, S.STG_CENTRO_CUSTO), files.ingest_rejects(spark, path, S.STG_CENTRO_CUSTO)
    kept, rejected = rows(good), rows(bad)
    assert rows(landed.tables["stg"]) == kept and kept
    assert rows(landed.rejected, "linha") == rejected and rejected
    assert rows(landed.profile) == rows(quality.profile(good, "stg"))
    assert rows(landed.counts()) == [("stg", len(kept), len(rejected))]
    assert landed.profile.inputFiles() == []
    assert all(root in f for f in landed.tables["stg"].inputFiles())


def test_an_empty_file_and_a_second_load(spark):
    root = tempfile.mkdtemp(prefix="ll-landed-")
    empty = pipeline.land(spark, {"stg": files.raw_lines(spark, _raw("id_cc,nome_cc\n"), S.STG_CENTRO_CUSTO)}, root)
    assert empty.tables["stg"].count() == 0 and rows(empty.counts()) == [("stg", 0, 0)]
    assert {r["qtd"] for r in empty.profile.collect()} == {0}
    again = pipeline.land(spark, {"stg": files.raw_lines(spark, _raw(), S.STG_CENTRO_CUSTO)}, root)
    assert again.tables["stg"].count() > 0 and empty.tables["stg"].count() == 0          # readers of the old version go on


@pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="test data not present")
def test_one_job_a_table(spark):
    stg = staging(spark, SMOKE_DIR)
    base = tempfile.mkdtemp(prefix="ll-landed-")
    for name, raw in pipeline.RAW_FILES.items():
        files.write_csv(stg[name], f"{base}/raw/{raw}")
    frames = pipeline.raw_frames(spark, f"{base}/raw")
    spark.sparkContext.setJobGroup("landing", "landing")
    landed = pipeline.land(spark, frames, f"{base}/bronze")
    spark.sparkContext.setJobGroup("others", "others")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("landing")) == len(pipeline.RAW_FILES)
    for name in stg:
        assert rows(landed.profile.filter(f"tabela = '{name}'")) == rows(quality.profile(landed.tables[name], name))
