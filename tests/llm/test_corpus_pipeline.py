import corpus_pipeline as pipeline
from edges import edge_docs, empty_docs
from test_lines import brute as brute_lines
from test_packing import check
from test_similarity import brute as brute_near

from ledgerlight.llm import mixing, quality
from ledgerlight.llm.shared import stored

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = stored(pipeline.quality(spark, docs, SF), "test")
    assert kept.columns == docs.columns
    verdict = {r["key"] for r in quality.quality_rules(docs).where("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == verdict and kept.join(docs, docs.columns, "left_semi").count() == len(verdict)

    cut = stored(pipeline.lines(spark, kept, SF), "test")
    want = {k: t for k, t in brute_lines({r["doc_id"]: r["text"] for r in kept.collect()}, 2).items() if t.encode().split()}
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == want and cut.columns == docs.columns
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect())

    apart = stored(pipeline.near(spark, cut, SF), "test")
    groups = brute_near({r["doc_id"]: r["text"] for r in cut.collect()}, 5, 80)
    assert sorted(r["doc_id"] for r in apart.collect()) == sorted(k for k, (_, c) in groups.items() if k == c)

    mixed = stored(pipeline.mixture(spark, apart, SF), "test")
    taken = {}
    for r in mixed.collect():
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + 1
    assert {r["key"]: len(r["shards"]) for r in mixing.mix(apart).collect() if r["shards"]} == taken and mixed.columns == docs.columns

    pieces = pipeline.packed(spark, mixed, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    assert check([{**r.asDict(), "key": r["doc_id"]} for r in pieces], {}, 1024) > 0.9 and {r["doc_id"] for r in pieces} == set(texts)
    for k in texts:
        own = [r for r in pieces if r["doc_id"] == k]
        assert sum(r["length"] for r in own) == taken[k] * own[0]["doc_tokens"]


def test_edge_rows(spark):
    for docs in (edge_docs(spark), empty_docs(spark)):
        for _, stage in pipeline.STAGES:
            docs = stored(stage(spark, docs, SF), "test")
        assert "sequence_id" in docs.columns


def test_run(spark):
    out = pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0 and len(pipeline.STAGES) == 5


def test_different_rows_under_one_id_stay(spark):
    long = lambda w: " ".join(f"{w}{i}" for i in range(30))
    rows = [(1, "alpha beta gamma"), (1, "delta epsilon zeta eta theta"), (2, long("a")), (3, long("a")), (3, long("b")), (3, long("b")), (None, long("c")), (None, long("c"))]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((str(r["doc_id"]), r["text"]) for r in pipeline.near(spark, docs, SF).collect())
    assert got == sorted([("1", "alpha beta gamma"), ("1", "delta epsilon zeta eta theta"), ("2", long("a")), ("3", long("b")), ("None", long("c")), ("None", long("c"))])
