"""Structured Streaming ingest gives the batch silver rows; replays add nothing."""

import os
import tempfile

from conftest import SMOKE_DIR, rows
from ledgerlight.plans import gold
from ledgerlight.plans import silver as silver_plan
from ledgerlight.plans.config import TESTDATA
from ledgerlight.plans.registry import silver, staging
from ledgerlight.sources import files
from ledgerlight.streaming import ledger_stream
from pyspark.sql import functions as F
import pytest


@pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="test data not present")
def test_stream_ingest_equals_batch_and_is_idempotent(spark):
    base = tempfile.mkdtemp(prefix="ll-stream-")
    stg = staging(spark, SMOKE_DIR)["stg_lancamentos"]
    files.write_csv(stg.repartition(3), f"{base}/landing")
    sv = silver(spark, SMOKE_DIR)
    q = ledger_stream.start_ingest(spark, f"{base}/landing", f"{base}/out", f"{base}/ckpt", sv, TESTDATA)
    q.awaitTermination()
    got = ledger_stream.read_ingested(spark, f"{base}/out").select("id_lancamento", "valor")
    want = sv.fact_lancamentos.select("id_lancamento", "valor")
    assert rows(got) == rows(want)
    rej = ledger_stream.read_ingested(spark, f"{base}/out", "rejects_lancamentos")
    assert rej.count() == sv.rejects_lancamentos.count()
    # restart on the same checkpoint: nothing new landed, nothing is added
    q2 = ledger_stream.start_ingest(spark, f"{base}/landing", f"{base}/out", f"{base}/ckpt", sv, TESTDATA)
    q2.awaitTermination()
    assert ledger_stream.read_ingested(spark, f"{base}/out").count() == want.count()


def _landing(base):
    os.makedirs(f"{base}/landing")

    def land(name, *lines):
        with open(f"{base}/landing/{name}.csv", "w") as fh:
            fh.write("h1,h2,h3,h4,h5,h6,h7,h8\n" + "".join(x + "\n" for x in lines))
    return land


def _small_silver(spark):
    dims = {
        "stg_dim_campanha": spark.createDataFrame([("1", "Urgent", "5")], "id_camp string, nome_camp string, mes_ref string"),
        "stg_dim_centro_custo": spark.createDataFrame([("1", "A")], "id_cc string, nome_cc string"),
        "stg_dim_categoria": spark.createDataFrame([("101.0", "1.0", "X")], "id_cat string, id_cc string, nome_cat string"),
        "stg_dim_fornecedores": spark.createDataFrame([("7", "S")], "id_forn string, nome_forn string"),
    }
    return silver_plan.Silver(spark, dims, TESTDATA.with_(load_date=TESTDATA.calendar_end.replace(year=2030)))


def test_daily_totals_take_late_files_and_reject_known_ids(spark):
    base = tempfile.mkdtemp(prefix="ll-stream-agg-")
    land, sv = _landing(base), _small_silver(spark)

    def run():
        ledger_stream.start_daily_totals(spark, f"{base}/landing", f"{base}/out", f"{base}/ckpt", sv, sv.cfg).awaitTermination()
        return {str(r["data_lancamento"]): float(r["total_do_dia"]) for r in ledger_stream.read_daily_totals(spark, f"{base}/out").collect()}

    land("a", "1,2024-01-05,1,101,7,1.0,10.50,Pago", "2,2024-01-05,1,101,7,,5.00,PAGO", "3,2024-02-01,1,101,7,,1.00,PAGO")
    assert run() == {"2024-01-05": 15.5, "2024-02-01": 1.0}
    # months later: an old day, and an id that is loaded already
    land("b", "4,2024-01-05,1,101,7,,4.00,Pago", "3,2024-02-01,1,101,7,,9.00,PAGO", "5,2023-06-01,1,101,7,,2.00,PAGO")
    assert run() == {"2024-01-05": 19.5, "2024-02-01": 1.0, "2023-06-01": 2.0}
    rejects = ledger_stream.read_ingested(spark, f"{base}/out", "rejects_lancamentos").collect()
    assert [(r["id_lancamento"], r["regras_violadas"]) for r in rejects] == [(3, ["id_lancamento_unique"])]


def _spoil(folder):
    """Make every file of a table unreadable."""
    for root, _, names in os.walk(folder):
        for n in names:
            if n.endswith(".parquet"):
                with open(os.path.join(root, n), "wb") as fh:
                    fh.write(b"no parquet")


def test_a_batch_of_new_ids_reads_no_earlier_batch(spark):
    base = tempfile.mkdtemp(prefix="ll-stream-ids-")
    land, sv = _landing(base), _small_silver(spark)

    def run():
        ledger_stream.start_ingest(spark, f"{base}/landing", f"{base}/out", f"{base}/ckpt", sv, sv.cfg).awaitTermination()

    far = ledger_stream.ID_RANGE * 3
    land("a", "1,2024-01-05,1,101,7,,1.00,PAGO", f"{far},2024-01-05,1,101,7,,1.00,PAGO")
    run()
    # an old id from the middle of the loaded ones, one between two ranges, and a repeat inside the batch
    land("b", f"{far},2024-01-09,1,101,7,,9.00,PAGO", "2,2024-01-06,1,101,7,,1.00,PAGO", f"{far // 2},2024-01-06,1,101,7,,1.00,PAGO", "2,2024-01-07,1,101,7,,1.00,PAGO")
    run()
    ids = [r[0] for r in ledger_stream.read_ingested(spark, f"{base}/out").select("id_lancamento").collect()]
    assert sorted(ids) == [1, 2, far // 2, far]
    rejects = ledger_stream.read_ingested(spark, f"{base}/out", "rejects_lancamentos").select("id_lancamento", "lote").collect()
    assert sorted(map(tuple, rejects)) == [(2, 1), (far, 1)]
    for table in ("fact_lancamentos", "rejects_lancamentos", "ids_lancamentos"):
        _spoil(f"{base}/out/{table}")
    land("c", f"{far * 2},2024-01-05,1,101,7,,3.00,PAGO", f"{far * 2 + 1},2024-01-05,1,101,7,,3.00,PAGO")
    run()
    new = spark.read.parquet(f"{base}/out/fact_lancamentos/ano=2024/mes=1/lote=2").select("id_lancamento").collect()
    assert sorted(r[0] for r in new) == [far * 2, far * 2 + 1]


@pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="test data not present")
def test_running_totals_of_the_stream_equal_the_view_after_late_files(spark):
    base = tempfile.mkdtemp(prefix="ll-stream-run-")
    sv = silver(spark, SMOKE_DIR)
    stg = staging(spark, SMOKE_DIR)["stg_lancamentos"].filter(F.col("data_lancamento").startswith("1997-0")).checkpoint()
    late = F.col("id_lancamento").cast("long") % 5 == 0

    def run(rows_, name):
        files.write_csv(rows_.coalesce(1), f"{base}/{name}")
        os.makedirs(f"{base}/landing", exist_ok=True)
        for n in os.listdir(f"{base}/{name}"):
            if n.endswith(".csv"):
                os.link(f"{base}/{name}/{n}", f"{base}/landing/{name}-{n}")
        ledger_stream.start_running_totals(spark, f"{base}/landing", f"{base}/out", f"{base}/ckpt", sv, TESTDATA).awaitTermination()

    first = ~F.coalesce(late, F.lit(False))
    run(stg.filter(first), "a")
    run(stg.filter(~first), "b")
    entries = ledger_stream.read_ingested(spark, f"{base}/out").select(*sv.fact_lancamentos.columns)
    want = gold.with_ledger_mtd(entries)
    got = ledger_stream.read_running_totals(spark, f"{base}/out")
    cols = ["id_lancamento", "data_lancamento", "valor", *gold.MTD_COLUMNS]
    assert entries.count() > 100 and rows(got, *cols) == rows(want, *cols)
