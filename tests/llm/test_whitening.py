import math

import numpy as np
import pytest

from ledgerlight.llm import whitening

SF = "/root/testdata/sf0.01"


def exact(rows):
    """x as whole numbers of usable rows, covariance, and deviations as Python integers."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - b) ** 2 for a, b in zip(row, sums)) for row in x]
    z = np.array([[n * a - b for a, b in zip(row, sums)] for row in x], dtype=float) / n
    return z, z.T @ z / n, deviation


def check(found, ids, rows, k):
    z, v, deviation = exact(rows)
    values = np.sort(np.linalg.eigvalsh(v))[::-1]
    by = {}
    for r in found:
        by.setdefault(r["component"], {}).setdefault(r["key"], []).append(r)
    assert sorted(by) == list(range(1, k + 1))
    for c, of in by.items():
        w = np.array([of[i][0]["whitened"] for i in ids])
        assert sum(map(len, of.values())) == len(ids)
        assert [of[i][0]["deviation"] for i in ids] == deviation and of[ids[0]][0]["n"] == len(ids)
        assert abs(of[ids[0]][0]["explained"] / (values[c - 1] / np.trace(v)) - 1) < 1e-10
        # whitened = z u / sqrt(e) gives back the eigenvector: V u = e u
        u = z.T @ w / len(ids) / math.sqrt(values[c - 1])
        assert abs(np.linalg.norm(u) - 1) < 1e-9 and np.abs(v @ u - values[c - 1] * u).max() < 1e-10 * values[0]
        assert np.allclose(z @ u / math.sqrt(values[c - 1]), w, atol=1e-7)
    assert all(r["identity_error"] < 1e-9 for r in found)


def test_whole_table_against_dense_eigenvectors(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = whitening.op13_whiten_embeddings(spark, SF)
    assert rows.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    usable = [r for r in table if r["embedding"] is not None and all(c is not None and math.isfinite(c) for c in r["embedding"])]
    check(rows.withColumnRenamed("vec_id", "key").collect(), [r["vec_id"] for r in usable], [r["embedding"] for r in usable], 32)


@pytest.mark.parametrize("dims,wanted,kind", [(200, 8, "gap"), (200, 12, "flat"), (120, 10, "double"), (90, 6, "close"), (5, 5, "gap"), (1, 1, "gap")])
def test_pairs_to_double_precision(dims, wanted, kind):
    rng = np.random.default_rng(dims + wanted)
    q = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
    values = {"gap": 0.8 ** np.arange(dims), "flat": 1 + np.sort(rng.random(dims))[::-1],
              "double": np.repeat(np.linspace(2, 1, -(-dims // 2)), 2)[:dims], "close": 1 + 1e-7 * np.arange(dims)[::-1]}[kind]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    passes = []
    found = whitening.leading_pairs(lambda b: passes.append(b.shape[1]) or a @ b, dims, wanted)
    assert np.abs(found.values - values[:wanted]).max() < 1e-12 * values[0]
    assert np.abs(found.vectors.T @ found.vectors - np.eye(wanted)).max() < 1e-12
    assert np.linalg.norm(a @ found.vectors - found.vectors * found.values, axis=0).max() < 1e-12 * values[0]
    assert len(passes) < 400


def test_minres_solves_the_projected_equations():
    rng = np.random.default_rng(4)
    a = rng.standard_normal((40, 40))
    a = a @ a.T
    away = np.linalg.qr(rng.standard_normal((40, 3)))[0]
    right = rng.standard_normal((40, 5))
    p = np.eye(40) - away @ away.T
    shifts = np.array([0.0, -1, -5, 30, 60])
    with pytest.MonkeyPatch.context() as m:
        m.setattr(whitening, "INNER", 120)
        m.setattr(whitening, "INNER_SHARE", 1e-9)
        x = whitening._minres(lambda b: a @ b, shifts, away, right)
    for j in range(5):
        rest = p @ (a @ x[:, j] - shifts[j] * x[:, j]) - p @ right[:, j]
        assert np.linalg.norm(rest) < 1e-6 * np.linalg.norm(right[:, j])


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 3.0]), (2, [2.0, 0.5, 1.0]), (2, [2.0, 0.5, 1.0]), (None, [0.0, 1.0, -4.0]), (2**53 + 1, [5.0, 5.0, 0.25]),
            (5, None), (6, []), (7, [1.0, None, 2.0]), (8, [1.0, nan, 2.0]), (9, [inf, 1.0, 1.0]), (10, [1.0, 2.0]), (11, [1e300, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'clash' AS x", "'clash' AS w", "1 AS n", "'c' AS component").repartition(3)
    found = whitening.whiten(df).collect()
    assert len(found) == 5 * 3 and {r["key"] for r in found} == {1, 2, None, 2**53 + 1}
    z, v, deviation = exact([r[1] for r in rows[:5]])
    one = {r["key"]: r for r in found if r["component"] == 1}
    assert one[1]["deviation"] == deviation[0] and one[None]["deviation"] == deviation[3] and one[1]["identity_error"] < 1e-9
    assert whitening.whiten(df.limit(0)).count() == 0 and whitening.whiten(df.where("vec_id = 1")).count() == 0
    assert whitening.whiten(df.where("vec_id = 2")).count() == 0                            # equal vectors: no variance
    flat = whitening.whiten(df.where("vec_id in (1, 2)")).collect()                           # on a line: one component
    assert {r["component"] for r in flat} == {1} and abs(flat[0]["explained"] - 1) < 1e-12
    wide = spark.createDataFrame([(i, [float(i) * 2.0**40, 1.0 * (i % 3)]) for i in range(50)], "vec_id long, embedding array<double>")
    assert all(r["deviation"] is None or r["deviation"] < 2**63 for r in whitening.whiten(wide).collect())


def test_sums_of_many_tasks_go_through_other_tasks(spark, monkeypatch):
    df = spark.range(600).selectExpr("id AS vec_id", "array(sin(id), cos(id * 3), sin(id * 7)) AS embedding").repartition(30)
    stored, dims = whitening.kept_vectors(df, "vec_id", "embedding")
    direct = whitening.Vectors(stored.repartition(12), dims)
    monkeypatch.setattr(whitening, "DIRECT", 4)
    tree = whitening.Vectors(stored.repartition(12), dims)
    assert direct.n == tree.n == 600 and np.allclose(direct.times(np.eye(3)), tree.times(np.eye(3)), rtol=1e-12)
