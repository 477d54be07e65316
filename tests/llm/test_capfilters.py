import math

import numpy as np
import pytest

from ledgerlight.llm import capfilters
from ledgerlight.llm.capfilters import near_vectors


def brute(rows, threshold=0.98):
    """Links and components over all pairs of one label."""
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (_, v, a) in enumerate(rows):
        for j, (_, w, b) in enumerate(rows[:i]):
            if a == b and a is not None and sound(v) and sound(w) and len(v) == len(w):
                x, y = np.array(v, dtype=float), np.array(w, dtype=float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                    links[i] += 1
                    links[j] += 1
                    p, q = find(i), find(j)
                    root[max(p, q)] = min(p, q)
    least = {}
    for i, (k, _, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), k), k)
    return sorted((k, links[i], least[find(i)]) for i, (k, _, _) in enumerate(rows))


def sound(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def found(df):
    return sorted((r["key"], r["n_links"], r["component"]) for r in near_vectors(df).collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)


def test_given_vectors_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert found(df) == brute(rows)


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold, the hardest ones: at least 0.9 of their links, and none below."""
    rng = np.random.default_rng(2)
    rows, want = [], 0
    for i in range(1500):
        x, z = rng.standard_normal(64), rng.standard_normal(64)
        x /= np.linalg.norm(x)
        z -= (z @ x) * x
        z /= np.linalg.norm(z)
        c = 0.9805 if i % 2 else 0.979
        want += i % 2
        rows += [(2 * i, x.tolist(), i % 3), (2 * i + 1, (3 * (c * x + math.sqrt(1 - c * c) * z)).tolist(), i % 3)]
    got = found(frame(spark, rows))
    linked = {k for k, n, _ in got if n}
    assert all((k // 2) % 2 for k in linked)
    assert len(linked) / 2 / want >= 0.97


def planted(rng, dim, count, cosine=0.9801):
    """``count`` vectors and as many partners at the cosine."""
    x, z = rng.standard_normal((2, count, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    return x, cosine * x + math.sqrt(1 - cosine * cosine) * z


@pytest.mark.parametrize("dim", [2, 3, 4, 8, 16, 32, 64, 128, 384, 768])
@pytest.mark.parametrize("size", [16, 125, 1000])
def test_lists_stay_short_and_partners_meet_in_any_dimension(dim, size):
    """At each code size, pairs at the threshold meet, and a list holds few of the directions."""
    some, partners = planted(np.random.default_rng([dim, size]), dim, 400)
    code = capfilters.fitted(dim, size, capfilters.MARGIN)
    best, lists = capfilters.decode(some, *code)
    best_of_partner, partner_lists = capfilters.decode(partners, *code)
    met = [b in q or c in p for b, c, p, q in zip(best, best_of_partner, lists, partner_lists)]
    assert np.mean(met) >= 0.9
    assert np.mean([len(x) for x in lists]) <= 128


@pytest.mark.parametrize("dim", [3, 16, 256])
def test_recall_in_other_dimensions(spark, dim):
    x, y = planted(np.random.default_rng(dim), dim, 300)
    rows = [(i, v.tolist(), i % 300) for i, v in enumerate([*x, *y])]        # a pair has a label of its own
    got = found(frame(spark, rows))
    assert sum(n for _, n, _ in got) / 600 >= 0.9


def test_hot_groups_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(capfilters, "BLOCK", 16)
    rng = np.random.default_rng(3)
    center = rng.standard_normal(16)
    rows = [(i, (center + 0.12 * rng.standard_normal(16)).astype(np.float32).tolist(), 1) for i in range(150)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(40)] + [(2000 + i, rng.standard_normal(16).astype(np.float32).tolist(), 1) for i in range(100)]
    assert found(frame(spark, rows)) == brute(rows)


def test_edge_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (2, v, 1), (2, v, 1), (3, v, None), (4, None, 1), (5, [], 1), (6, [0.0] * 3, 1), (7, [1.0, None, 3.0], 1),
            (8, [1.0, float("nan"), 3.0], 1), (9, [float("inf"), 2.0, 3.0], 1), (10, [-1.0, -2.0, -3.0], 1), (11, v, 2), (12, [1.0, 2.0], 1), (13, [2.0, 4.0, 6.0], 1),
            (14, [1e30, 2e30, 3e30], 1), (15, [5.0], 1), (16, [7.0], 1)]
    df = frame(spark, rows).selectExpr("*", "'c' AS node", "'c' AS key", "'c' AS n", "'c' AS component")
    assert found(df) == brute(rows)
    null = frame(spark, [(None, v, 1), (1, v, 1)])
    assert sorted(((r["key"] or -1), r["n_links"], r["component"]) for r in near_vectors(null).collect()) == [(-1, 0, None), (1, 0, 1)]
    assert near_vectors(df.limit(0)).count() == 0
