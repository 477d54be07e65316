import math

import duckdb
from pyspark.sql import functions as F

from edges import edge_docs, empty_docs, rows_by_key
from ledgerlight.llm import mixing

SF = "/root/testdata/sf0.001"


def brute_targets(sizes):
    """Share out, cap, share the excess again until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in capped)
        w = sum(weight[s] for s in order if s not in capped)
        target = {s: 2 * sizes[s] if s in capped else rest * weight[s] / w for s in order}
        over = {s for s in order if s not in capped and target[s] > 2 * sizes[s]}
        if not over:
            return target
        capped |= over


def test_targets(spark):
    cases = [{"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5, "d": 70, None: 30, "": 9}, {"x": 10}, {"é": 7, "z": 7, "Z": 7, None: 0}]
    for sizes in cases:
        df = spark.createDataFrame([(s, n // 2) for s, n in sizes.items()] + [(s, n - n // 2) for s, n in sizes.items()], "source string, size long")
        got = {r["source"]: (r["source_size"], r["target"]) for r in mixing.targets(df).collect()}
        want = brute_targets(sizes)
        assert got.keys() == sizes.keys()
        assert all(got[s][0] == sizes[s] and math.isclose(got[s][1], want[s], abs_tol=1e-9) for s in sizes)


def test_hypergeometric_draws(spark):
    for n, k, d in ((60, 25, 30), (10, 9, 9), (1000, 3, 500), (50, 50, 20), (50, 0, 20)):
        u = (F.col("id") + 0.5) / 20000
        got = spark.range(20000).select(mixing._hypergeometric(F.lit(n), F.lit(k), F.lit(d), u).alias("x")).groupBy("x").count().collect()
        assert all(abs(r["count"] / 20000 - math.comb(k, r["x"]) * math.comb(n - k, d - r["x"]) / math.comb(n, d)) < 2e-4 for r in got)


def test_tree_splits_quotas_exactly(spark):
    quota = {0: 37, 1: 5, 2: 0, 3: 118}
    leaves = mixing.splitting_tree(spark.createDataFrame(list(quota.items()), "rank int, n long"), 4).collect()
    by_shard = {}
    for r in leaves:
        by_shard[r["shard"]] = by_shard.get(r["shard"], 0) + r["n"]
    assert set(by_shard) == set(range(16)) and max(by_shard.values()) - min(by_shard.values()) <= 1
    for rank, n in quota.items():
        at = 0
        for r in sorted((r for r in leaves if r["rank"] == rank), key=lambda r: r["start"]):
            assert r["start"] == at and r["n"] > 0
            at += r["n"]
        assert at == n


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    cols = "doc_id, size, source_size, target, taken"
    want = sorted(con.execute(f"SELECT {cols} FROM ({mixing.SQL})").fetchall())
    got = sorted(tuple(r) for r in mixing.op10_mix_sources(spark, SF).selectExpr(*cols.split(", ")).collect())
    assert got == want


def test_many_blocks_and_shards(spark):
    """A hot source in many blocks: near the targets, at most twice, shards even, the same again."""
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(1 + id % 37 as int))").alias("text"),
                                    F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 101 = 0 THEN NULL ELSE concat('s', id % 5) END").alias("source"))
    plan = mixing.mix(docs, block_words=256, shard_words=4096)
    rows = plan.collect()
    assert len(rows) == 6000 and max(len(r["shards"]) for r in rows) <= 2
    taken, target, shards = {}, {}, {}
    for r in rows:
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * len(r["shards"])
        target[r["source"]] = r["target"]
        for s in r["shards"]:
            shards[s] = shards.get(s, 0) + r["size"]
    assert all(abs(taken[s] - target[s]) <= 37 for s in taken)
    assert len(shards) >= 32 and max(shards.values()) < 2 * min(shards.values())
    again = mixing.mix(docs.repartition(7), block_words=256, shard_words=4096).collect()
    assert sorted((r["key"], r["shards"]) for r in rows) == sorted((r["key"], r["shards"]) for r in again)
    out = mixing.drawn(docs, plan)
    assert out.count() == sum(len(r["shards"]) for r in rows) and out.agg(F.sum(F.size(F.split(F.trim("text"), " ")))).first()[0] == sum(taken.values())


def test_edge_rows(spark):
    df = edge_docs(spark)
    got = rows_by_key(mixing.mix(df))
    assert sum(map(len, got.values())) == df.count() and len(got[7]) == 2
    for k in (2, 3, 4):
        assert got[k][0]["size"] == 0 and got[k][0]["shards"] == []
    assert all(len(r["shards"]) <= 2 for rows in got.values() for r in rows)
    out = mixing.drawn(df, mixing.mix(df))
    assert out.where("source is not null").count() > 0 and set(df.columns) <= set(out.columns)
    assert mixing.mix(empty_docs(spark)).count() == 0
    nothing = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [r["shards"] for r in mixing.mix(nothing).collect()] == [[], []]


def test_different_rows_under_one_key_are_drawn_apart(spark):
    rows = [(1, "alpha beta gamma", "a", "x"), (1, "delta epsilon zeta eta theta", "a", "y"), (None, "iota kappa", "a", "z"), (None, "lambda", "b", "z"),
            (2, "mu nu", "b", "w"), (2, "mu nu", "b", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    plan = mixing.mix(docs)
    wanted = {}
    for r in plan.collect():
        text = {(1, 3): "alpha beta gamma", (1, 5): "delta epsilon zeta eta theta", (None, 2): "iota kappa", (None, 1): "lambda", (2, 2): "mu nu"}[r["key"], r["size"]]
        wanted[r["key"], text] = wanted.get((r["key"], text), 0) + len(r["shards"])
    got = {}
    for r in mixing.drawn(docs, plan).collect():
        got[r["doc_id"], r["text"]] = got.get((r["doc_id"], r["text"]), 0) + 1
    assert got == {k: n for k, n in wanted.items() if n} and len(got) >= 4
