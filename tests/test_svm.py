import numpy as np
from pyspark.sql import functions as F

from surveyloom.config import SurveyConfig
from surveyloom.operators import models, svm

COLUMNS = ["a", "b", "c"]


def table(spark, n=600):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((n, 3))
    y = np.digitize((x**2).sum(axis=1), [1.5, 3.5])
    rows = [(i, *map(float, r), float(c), 2.0 if c == 2 else 1.0) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y_index double, weight double").repartition(5)


def objective(z, y, w, weights, bias, c):
    sign = np.where(y == c, 1.0, -1.0)
    return (w * np.maximum(0, 1 - sign * (z @ weights + bias))).sum() / w.sum() + (weights**2).sum() / 2 / len(y)


def test_reaches_the_objective_of_spark_on_mapped_rows(spark):
    df = table(spark)
    phi = models.cubic_terms(3, 0.5)
    mine = svm.fit_mapped_svm(df, COLUMNS, phi)
    theirs = models.fit_svm(models.cubic_map(df, COLUMNS, 0.5, keep=["y_index", "weight"]), SurveyConfig())
    rows = df.toPandas()
    z, y, w = phi(rows[COLUMNS].to_numpy()), rows["y_index"].to_numpy(), rows["weight"].to_numpy()
    for c, one in enumerate(theirs.models):
        ours = objective(z, y, w, mine.weights[c], mine.bias[c], c)
        assert ours <= 1.02 * objective(z, y, w, one.coefficients.toArray(), one.intercept, c)


def test_no_mapped_row_is_stored_or_sent(spark, monkeypatch):
    df, seen = table(spark), []
    kept = svm._blocks
    monkeypatch.setattr(svm, "_blocks", lambda *a: seen.append(kept(*a)) or seen[-1])
    phi = models.fit_nystroem(df, COLUMNS, 0.5, key="id", size=64)
    model = svm.fit_mapped_svm(df, COLUMNS, phi)
    assert seen[0].agg(F.sum(F.length("block"))).first()[0] == 600 * 5 * 8
    got = model.transform(df)
    assert got.where("prediction = y_index").count() >= 540


def test_cubes_make_the_cubic_kernel_on_few_mapped_rows_at_a_time(spark, monkeypatch):
    x = np.random.default_rng(1).standard_normal((50, 7))
    phi = models.cubic_terms(7, 0.3)
    assert np.allclose(phi(x) @ phi(x).T, (0.3 * x @ x.T) ** 3)
    monkeypatch.setattr(svm, "HELD", 200)
    seen = []

    def watched(rows):
        seen.append(len(rows))
        return phi(rows)

    svm.MappedSvm(tuple("abcdefg"), watched, np.ones((2, 84)), np.zeros(2)).margins(x)
    assert sum(seen) == 50 and max(seen) == 2


def test_folded_maps_give_the_margins_and_gradients_of_the_mapped_rows():
    rng = np.random.default_rng(2)
    for width in (1, 2, 3, 18):
        x, pull = rng.standard_normal((40, width)), rng.standard_normal((40, 5))
        for phi in (models.cubic_terms(width, 0.3), models.Nystroem(x[:9], rng.standard_normal((9, 6)), 0.3)):
            z = phi(x)
            weights, base = rng.standard_normal((5, z.shape[1])), phi.base(x)
            assert np.allclose(phi.times(base, phi.folded(weights)), z @ weights.T)
            assert np.allclose(phi.unfolded(phi.back(base, pull)), pull.T @ z)


def test_a_folding_map_is_not_worked_out_to_predict():
    class Unmapped(models.Cubes):
        def __call__(self, x):
            raise AssertionError("mapped")

    terms = models.cubic_terms(3, 0.5)
    weights, x = np.ones((2, 10)), np.random.default_rng(3).standard_normal((20, 3))
    got = svm.MappedSvm(tuple("abc"), Unmapped(terms.positions, terms.coefficient), weights, np.zeros(2)).margins(x)
    assert np.allclose(got, terms(x) @ weights.T)
