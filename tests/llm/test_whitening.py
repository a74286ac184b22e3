import math

import numpy as np
import pytest

from carestar.llm import queries, whitening as W

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(vectors, k=16):
    """n, S, eigenvalues and eigenvectors of the distinct vectors, by a dense decomposition."""
    x = np.array([[math.floor(64 * c) + 1000000 for c in v] for v in vectors], np.int64)
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(0)
    cov = centred.T @ centred / len(fit)
    values, vecs = np.linalg.eigh(cov)
    return x, fit, values[::-1][:k], vecs[:, ::-1][:, :k], np.trace(cov)


def check(rows, ids, vectors, k=16, tolerance=1e-7):
    x, fit, values, vecs, trace = plain(vectors, k)
    n, sums = len(fit), [int(s) for s in fit.sum(0)]
    by = {}
    for r in rows:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    assert len(rows) == len(ids) * len(values)
    z = (x - fit.mean(0)) @ vecs / np.sqrt(values)
    signs = {}
    for i, (vec_id, row) in enumerate(zip(ids, x.tolist())):
        deviation = sum((n * c - s) ** 2 for c, s in zip(row, sums))
        for c in range(len(values)):
            r = by[vec_id, c + 1][0]
            assert r["n"] == n and r["deviation"] == (deviation if deviation < 1 << 63 else None)
            assert abs(r["explained"] / (values[c] / trace) - 1) < 1e-9 and r["identity_error"] < 1e-9
            if abs(z[i, c]) > 0.1:
                signs.setdefault(c, np.sign(z[i, c]) * np.sign(r["whitened"]))
            assert abs(abs(r["whitened"]) - abs(z[i, c])) < tolerance
            assert c not in signs or abs(r["whitened"] * signs[c] - z[i, c]) < tolerance


def test_query_against_a_dense_decomposition(spark):
    given = queries.table(spark, SF, "embeddings").collect()
    rows = queries.op11_whitening(spark, SF).collect()
    check(rows, [r["vec_id"] for r in given], [r["embedding"] for r in given])


def test_odd_rows_ties_and_clashing_columns(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 20)) * np.linspace(3, 0.2, 20)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(base)]
    rows += [(100 + i, base[0].tolist(), 0) for i in range(30)]               # a third of the rows equal
    good = len(rows)
    rows += [(200, None, 0), (201, [1.0, None] * 10, 0), (202, [math.nan] * 20, 0), (203, [math.inf] * 20, 0), (204, [1.0, 2.0], 0), (205, [], 0),
             (206, [1e300] * 20, 0)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n", "2 AS x", "'q' AS dim", "4 AS component")
    check(W.whiten(df).collect(), [r[0] for r in rows[:good]], [r[1] for r in rows[:good]])


def test_low_rank_repeated_eigenvalues_and_small_tables(spark):
    def run(vectors):
        return W.whiten(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA)).collect()
    assert run([]) == []
    assert run([[1.0, 2.0]] * 5) == []                                        # one distinct vector has no variance
    flat = [[float(a), float(a), 0.0, 1.0] for a in range(6)]
    assert {r["component"] for r in run(flat)} == {1}
    corners = [[float(s if j == i else 0) for j in range(24)] for i in range(24) for s in (-1, 1)]
    rows = run(corners)                                                       # all 24 eigenvalues are equal
    assert {r["component"] for r in rows} == set(range(1, 17))
    assert all(abs(r["explained"] - 1 / 24) < 1e-12 and r["identity_error"] < 1e-9 for r in rows)
    pairs = [[float(s * (5 if i < 4 else 1) if j == i else 0) for j in range(60)] for i in range(60) for s in (-1, 1)]
    got = sorted({(r["component"], round(r["explained"], 9)) for r in run(pairs)})
    assert [v for _, v in got] == [round(25 / 156, 9)] * 4 + [round(1 / 156, 9)] * 12


def test_large_numbers_stay_exact(spark):
    vectors = [[1e9 * i, 2.5e8 * (i % 3), 7.0] for i in range(10)]
    rows = W.whiten(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA)).collect()
    x, fit, *_ = plain(vectors)
    sums = [int(s) for s in fit.sum(0)]
    for r in rows:
        want = sum((len(fit) * c - s) ** 2 for c, s in zip(x[r["vec_id"]].tolist(), sums))
        assert r["deviation"] == (want if want < 1 << 63 else None)
    assert {r["component"] for r in rows} == {1, 2}


def test_steps_end_early_where_the_spectrum_falls(spark):
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((300, 200)) * (100 * 0.5 ** np.arange(200) + 1e-3)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], SCHEMA)
    steps, products = [], W.Centred.products
    W.Centred.products = lambda self, w, e: (steps.append(1), products(self, w, e))[1]
    try:
        rows = W.whiten(df, components=3).collect()
    finally:
        W.Centred.products = products
    assert len(steps) < 100
    check(rows, list(range(300)), vectors.tolist(), k=3)


@pytest.mark.parametrize("fan", [1, 3])
def test_partial_sums_by_levels(spark, fan, monkeypatch):
    monkeypatch.setattr(W, "FAN", fan + 1)
    rng = np.random.default_rng(7)
    vectors = rng.standard_normal((50, 4)).tolist()
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA).repartition(9)
    check(W.whiten(df).collect(), list(range(50)), vectors)
