import random

import numpy as np
import pytest

from edges import edge_docs, empty_docs, rows_by_key
from ledgerlight.llm import similarity
from ledgerlight.llm.similarity import near_duplicates

SF = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, n):
    w = [x.decode().translate(LOWER) for x in (text or "").encode().split()]
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute(docs, n, percent):
    """Sizes and components by comparing all pairs that share a shingle."""
    sets = {k: shingles(t, n) for k, t in docs.items()}
    root = {k: k for k in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    holders = {}
    for k in sorted(sets):
        common = {}
        for s in sets[k]:
            for j in holders.setdefault(s, []):
                common[j] = common.get(j, 0) + 1
            holders[s].append(k)
        for j, c in common.items():
            if 100 * c >= percent * (len(sets[k]) + len(sets[j]) - c):
                a, b = find(k), find(j)
                root[max(a, b)] = min(a, b)
    return {k: (len(sets[k]), find(k)) for k in docs}


def found(df, **options):
    return {r["key"]: (r["n_shingles"], r["component"]) for r in near_duplicates(df, **options).collect()}


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80)])
def test_documents_against_brute_force(spark, words, percent):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    docs = {r["doc_id"]: r["text"] for r in df.collect()}
    assert found(df, words=words, percent=percent) == brute(docs, words, percent)


@pytest.mark.parametrize("percent", [90, 80])
def test_near_copies_around_the_threshold(spark, percent):
    rng = random.Random(percent)
    vocabulary = [f"w{i}" for i in range(3000)]
    docs, k = {}, 0
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([6, 12, 40, 90, 200]))]
        for _ in range(8):
            own = list(base)
            for _ in range(rng.randrange(0, 1 + len(own) // 25)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                own += [rng.choice(vocabulary) for _ in range(len(own) // 12)]
            docs[k] = " ".join(own)
            k += 1
    df = spark.createDataFrame([(i, t) for i, t in docs.items()], "doc_id long, text string").repartition(4)
    assert found(df, percent=percent) == brute(docs, 3, percent)


def test_large_group_of_chained_copies(spark, monkeypatch):
    """Groups and queries far smaller than the copies: the links between groups must hold them together."""
    monkeypatch.setattr(similarity, "GROUP_TOKENS", 600)
    monkeypatch.setattr(similarity, "QUERIES", 8)
    rng = random.Random(1)
    own = [f"w{rng.randrange(500)}" for _ in range(150)]
    docs = {}
    for i in range(120):                        # each a little further from the first: far ends do not link
        own = list(own)
        own[rng.randrange(150)] = f"n{i}"
        docs[1000 - i] = " ".join(own)
    df = spark.createDataFrame([(i, t) for i, t in docs.items()], "doc_id long, text string").repartition(4)
    assert found(df) == brute(docs, 3, 90)


def test_parts_cannot_miss():
    """Sets at the threshold always share a part key."""
    rng = np.random.default_rng(0)
    for percent in (80, 90):
        for _ in range(300):
            common = int(rng.integers(1, 400))
            most = common * (100 - percent) // percent
            extra = int(rng.integers(0, most + 1))
            one = int(rng.integers(0, extra + 1))
            tokens = rng.integers(0, 1 << 63, common + extra, dtype=np.uint64)
            a, b = np.unique(tokens[:common + one]), np.unique(np.concatenate([tokens[:common], tokens[common + one:]]))
            if extra:
                (x, need_x), (y, need_y) = similarity.part_keys(a, percent), similarity.part_keys(b, percent)
                assert len(set(x) & set(y)) >= max(need_x, need_y) >= 1, (percent, common, one, extra)


def test_edge_rows(spark):
    got = rows_by_key(near_duplicates(edge_docs(spark)))
    assert {r["component"] for k in (1, 7, None) for r in got[k]} == {1} and len(got[7]) == 2
    for k in (2, 3, 4):
        assert (got[k][0]["n_shingles"], got[k][0]["component"]) == (0, k)
    assert got[5][0]["n_shingles"] == 1 and got[6][0]["n_shingles"] == 6
    assert near_duplicates(empty_docs(spark)).count() == 0
