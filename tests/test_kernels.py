"""Kernel metrics against dense matrices, dominance ranks by hand."""

import numpy as np
import pytest

from surveyloom.operators import evaluate, kernels as K, models, report


def dense(k, y):
    n, yy = len(y), np.outer(y, y)
    d = np.diag(k)
    pol = (-yy * (d[:, None] + d[None] - 2 * k)).sum()
    ali = (k * yy).sum() / (np.linalg.norm(k) * n)
    p, q = y == 1, y == -1
    same_p, cross_p = k[np.ix_(p, p)].mean(1), k[np.ix_(p, q)].mean(1)
    same_q, cross_q = k[np.ix_(q, q)].mean(1), k[np.ix_(q, p)].mean(1)
    phi = same_p.mean() + same_q.mean() - cross_p.mean() - cross_q.mean()
    fsm = ((same_p - cross_p).std(ddof=1) + (same_q - cross_q).std(ddof=1)) / phi
    return [ali, pol, fsm, np.trace(k)]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(120, 4)), rng.integers(0, 3, size=120)
    df = spark.createDataFrame(
        [(i, *map(float, r), int(c)) for i, (r, c) in enumerate(zip(x, y))], "k long, a double, b double, c double, d double, y int"
    )
    return df, x, y


def test_metrics_equal_the_dense_definitions(data):
    df, x, y = data
    specs = K.weak_kernel_specs(["a", "b", "c", "d"], 6, seed=7)
    got = K.kernel_metrics(df, ["a", "b", "c", "d"], "y", specs, positive=1).orderBy("kernel").collect()
    for row, spec in zip(got, specs):
        at = ["abcd".index(c) for c in spec.columns]
        k = (x[:, at] @ x[:, at].T) ** spec.degree
        assert np.allclose(row[1:], dense(k, np.where(y == 1, 1, -1)), rtol=1e-8)


def test_published_draws():
    names = [str(i) for i in range(18)]
    drawn = [([int(c) for c in k.columns], k.degree) for k in K.weak_kernel_specs(names, 3, seed=42)]
    assert drawn == [([13], 2), ([7, 15, 1], 3), ([1, 9], 3)]


def test_maps_reproduce_their_kernels(data):
    df, x, _ = data
    names = ["a", "b", "c", "d"]
    phi = np.array([r["features"].toArray() for r in models.cubic_map(df, names, 0.3, keep=["k"]).orderBy("k").collect()])
    assert np.allclose(phi @ phi.T, (0.3 * x @ x.T) ** 3)
    wave = np.array([r["features"].toArray() for r in models.rbf_map(df, names, 0.2, size=4096, seed=1, keep=["k"]).orderBy("k").collect()])
    exact = np.exp(-0.2 * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(wave @ wave.T - exact).max() < 0.1


def test_class_with_one_row_has_no_fsm(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 0), (3.0, 0)], "a double, y int")
    row = K.kernel_metrics(df, ["a"], "y", [K.WeakKernel(("a",), 1)], positive=1).first()
    assert row["FSM"] is None and row["complex_ratio"] == pytest.approx(14.0)


def ranks(spark, rows, directions):
    df = spark.createDataFrame(rows, "kernel int, p double, q double")
    return {r[0]: r[1] for r in K.dominance_rank(df, "kernel", directions).collect()}


def test_dominance_ranks(spark, monkeypatch):
    chain = [(0, 1.0, 1.0), (1, 2.0, 2.0), (2, 3.0, 3.0)]
    assert ranks(spark, chain, {"p": 1, "q": 1}) == {0: 3, 1: 2, 2: 1}
    assert ranks(spark, chain, {"p": -1, "q": -1}) == {0: 1, 1: 2, 2: 3}
    assert ranks(spark, [(0, 1.0, 2.0), (1, 2.0, 1.0)], {"p": 1, "q": 1}) == {0: 1, 1: 1}
    assert ranks(spark, [(0, 1.0, 1.0), (1, 1.0, 1.0)], {"p": 1, "q": 1}) == {0: 2, 1: 2}
    monkeypatch.setattr(K, "RANK_BLOCK", 7)
    rng = np.random.default_rng(0)
    v = rng.integers(0, 6, size=(60, 2)).astype(float)
    want = {i: int((v >= v[i]).all(1).sum()) for i in range(60)}
    assert ranks(spark, [(i, *map(float, r)) for i, r in enumerate(v)], {"p": 1, "q": 1}) == want


def test_weights_of_a_chain(spark):
    m = spark.createDataFrame([(0, 1.0, 1.0), (1, 2.0, 2.0), (2, 3.0, 3.0)], "kernel int, alignment double, FSM double")
    got = {r[0]: (r[1], r[2]) for r in K.extremality_weights(m).collect()}
    for i, w in enumerate((1 / 6, 2 / 6, 3 / 6)):
        assert got[i] == pytest.approx((w, w))
    strict = {r[0]: r[2] for r in K.extremality_weights(m, strict_anti=True).collect()}
    assert strict[0] == pytest.approx(3 / 6)
    natural, anti = K.local_weights([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0)], [1, 1], 1)
    assert natural == pytest.approx([1 / 6, 2 / 6, 3 / 6]) and anti == pytest.approx(natural)


def test_report_with_a_class_never_predicted(spark):
    rows = [("m", "Test", "a", "a"), ("m", "Test", "a", "a"), ("m", "Test", "b", "a")]
    p = spark.createDataFrame(rows, "model string, split string, y string, prediction string")
    confusion = evaluate.confusion_matrix(p, ["a", "b", "c"])
    assert confusion.count() == 9
    got = {r["class"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in evaluate.classification_report(confusion).collect()}
    assert got["b"] == (0.0, 0.0, 0.0, 1) and got["c"] == (0.0, 0.0, 0.0, 0)
    assert got["a"][:2] == pytest.approx((2 / 3, 1.0))
    sens = {r["class"]: (r["Sensitivity"], r["Specificity"]) for r in evaluate.sensitivity_specificity(confusion).collect()}
    assert sens["a"] == (1.0, 0.0) and sens["b"] == (0.0, 1.0) and sens["c"] == (0.0, 1.0)
    board = report.model_leaderboard(evaluate.classification_metrics(p, ["a", "b", "c"]), "Classification").first()
    assert board["Test_Accuracy"] == 0.6667 and board["Val_Accuracy"] is None


def test_leaderboard_of_no_models_is_empty(spark):
    assert report.model_leaderboard(evaluate.clustering_rows(spark, {}), "Regression").count() == 0


def test_cubic_sums_hold_every_moment_once(spark):
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(300, 4)), rng.integers(0, 2, 300)
    phi = K.Cubic(4)
    assert phi.size == 1 + 35 + 210  # not 35 · 35: C(4 + 6, 6) moments
    assert np.allclose(phi(x) @ phi(x).T, (x @ x.T / 4 + 1) ** 3)
    df = spark.createDataFrame([(int(c), *map(float, v)) for c, v in zip(y, x)], "y int, a double, b double, c double, d double")
    got = K.class_sums(df, list("abcd"), "y", {"cubic": phi, "plain": lambda v: phi(v)})
    for c in (0, 1):
        z = phi(x[y == c])
        for name in ("cubic", "plain"):
            assert got[name][c].n == len(z)
            assert np.allclose(got[name][c].total, z.sum(axis=0)) and np.allclose(got[name][c].gram, z.T @ z)
