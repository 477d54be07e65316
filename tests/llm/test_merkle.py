import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from edges import edge_docs, empty_docs
from ledgerlight.llm import merkle

SF = "/root/testdata/sf0.01"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def way(leaves, at):
    """Levels from leaf ``at``: (before, after) siblings, and the top."""
    steps, level = [], leaves
    while len(level) > 1:
        run = level[at // 3 * 3:at // 3 * 3 + 3]
        steps.append((run[:at % 3], run[at % 3 + 1:]))
        level = [sha(*level[i:i + 3]) for i in range(0, len(level), 3)]
        at //= 3
    return steps, level[0]


def brute_force(rows):
    """Expected result rows, by whole lists in memory."""
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r, leaf(r, r["text"])))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        groups[s].sort(key=lambda p: (p[0]["doc_id"] is not None, p[0]["doc_id"] or 0, p[1]))
    tops = [way([h for _, h in groups[s]], 0)[1] for s in names]
    out = []
    for n, s in enumerate(names):
        last, root = way(tops, n)
        for at, (r, h) in enumerate(groups[s]):
            steps, subroot = way([x for _, x in groups[s]], at)
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            folded = leaf(r, text)
            for before, after in steps + last:
                folded = sha(*before, folded, *after)
            proof = sha(*[x for before, after in steps + last for x in before + after])
            out.append((r["doc_id"], h, subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in df.collect()), key=str)


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute_force(docs.collect())
    assert got(merkle.op12_merkle_manifest(spark, SF)) == want
    verified = [r[-1] for r in want]
    assert any(verified) and not all(verified)


def test_edges(spark):
    docs = edge_docs(spark)
    assert got(merkle.manifest(docs).rows) == brute_force(docs.collect())
    assert merkle.manifest(empty_docs(spark)).rows.count() == 0
    one = docs.where("doc_id = 5")
    [row] = merkle.manifest(one).rows.collect()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("n", [2, 3, 4, 9, 10, 28])
def test_sizes_and_small_blocks(spark, monkeypatch, n):
    monkeypatch.setattr(merkle, "LEVELS", 1)              # every level a round of its own
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 5 > 0, F.lit("hot")).alias("source"), F.lit("en").alias("lang"),
                                 F.lit(7).alias("n_chars"), F.concat(F.lit("a\n"), F.col("id")).alias("text"))
    found = merkle.manifest(docs.repartition(4))
    assert got(found.rows) == brute_force(docs.collect())
    assert found.subroots.count() == min(2, len({r["source"] for r in docs.collect()}))


def test_a_changed_row_is_found_wherever_it_is(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.lit("en").alias("lang"),
                                  F.length(F.col("id").cast("string")).alias("n_chars"), F.col("id").cast("string").alias("text"))
    found = merkle.manifest(docs, tampered=lambda key, text: F.when(key == 17, merkle.leaf_hash(text=F.lit("18")))).rows
    assert [r["doc_id"] for r in found.where("NOT verified").collect()] == [17]
