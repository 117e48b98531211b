import numpy as np
import pytest

from patronscope.llm.whitening import leading_components, polar_factor, whitened_rows

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(vectors, k=16):
    """n, deviations, whitened, explained by numpy on the distinct vectors."""
    x = np.floor(64 * np.array(vectors, float)).astype(int) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1][:k], directions[:, ::-1][:, :k]
    return n, ((n * x - sums) ** 2).sum(axis=1), (n * x - sums) / n @ directions / np.sqrt(values), values / (centred**2).sum() * n


def check(spark, vectors, tolerance=1e-8):
    rows = [(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(vectors)]
    got, model = whitened_rows(spark.createDataFrame(rows, SCHEMA).repartition(4))
    n, deviation, white, explained = plain([v for _, v, _ in rows])
    by = {r["row"]["vec_id"]: r for r in got.collect()}
    assert model.n == n and model.identity_error < 1e-9
    assert [by[i]["deviation"] for i in range(len(rows))] == deviation.tolist()
    own = np.array([by[i]["whitened"] for i in range(len(rows))])
    signs = np.sign((own * white).sum(axis=0))
    assert np.allclose(own, white * signs, atol=tolerance) and np.allclose(model.explained, explained, rtol=1e-9)


def test_whitened_as_numpy(spark):
    rng = np.random.default_rng(0)
    vectors = rng.normal(0, np.linspace(0.2, 3, 24), (400, 24))
    vectors[100:230] = vectors[0]  # a third are copies: they count once
    check(spark, vectors)


def test_given_vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").orderBy("vec_id").collect()
    check(spark, [r["embedding"] for r in rows], 1e-7)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 1.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [1.0, inf]), (6, []), (7, [1.0]), (8, [0.5, 1.0]),
            (8, [0.5, 1.0]), (None, [0.25, 1.0]), (9, [1.0, 2.0, 3.0]), (10, [-inf, 0.0]), (11, [3e38, 0.0])]
    df = spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], "vec_id long, embedding array<float>, row string, x string, whitened string")
    got, model = whitened_rows(df)
    out = got.collect()
    assert sorted((r["row"]["vec_id"] for r in out), key=repr) == sorted([1, 8, 8, None], key=repr)
    assert {(r["row"]["row"], r["row"]["x"], r["row"]["whitened"]) for r in out} == {("a", "b", "c")}
    assert model.n == 3 and model.explained.tolist() == [1.0, 0.0] and model.identity_error < 1e-12
    assert all(r["whitened"][1] == 0.0 for r in out)  # no variance there
    for vectors in ([], [(1, None)], [(1, [nan])]):
        none, model = whitened_rows(spark.createDataFrame(vectors, "vec_id long, embedding array<float>"))
        assert none.count() == 0 and model is None
    one, model = whitened_rows(spark.createDataFrame([(1, [2.0, 3.0])] * 3, "vec_id long, embedding array<double>"))
    assert [(r["deviation"], r["whitened"]) for r in one.collect()] == [(0, [0.0, 0.0])] * 3
    wide, _ = whitened_rows(spark.createDataFrame([(i, [float((-1) ** i * 2.0**39)]) for i in range(2)], "vec_id long, embedding array<double>"))
    assert [r["deviation"] for r in wide.collect()] == [None, None] and abs(abs(wide.first()["whitened"][0]) - 1) < 1e-12


@pytest.mark.parametrize("kind", ["plain", "graded", "multiple", "deficient", "diagonal"])
def test_components(kind):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((90, 40))
    if kind == "graded":
        x *= np.logspace(0, -6, 40)
    a = x.T @ x / 90
    if kind == "multiple":
        q, _ = np.linalg.qr(x[:40])
        a = (q * np.repeat([3.0, 2.0, 1.0, 0.0], 10)) @ q.T
    elif kind == "deficient":
        a = x[:7].T @ x[:7]
    elif kind == "diagonal":
        a = np.diag(rng.integers(0, 4, 40).astype(float))
    values, vectors = leading_components(a, 16)
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:16], atol=1e-12 * np.linalg.norm(a))
    assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * np.linalg.norm(a)
    assert np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-13


def test_polar_factor():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((30, 30))
    for m in (a, a + a.T, a @ np.diag(np.logspace(0, -12, 30)) @ a.T):
        u, _, v = np.linalg.svd(m)
        got = polar_factor(m)
        assert np.abs(got.T @ got - np.eye(30)).max() < 1e-12
        assert np.abs(got - u @ v).max() < 1e-2 * max(1.0, np.linalg.cond(m) * 1e-12)
