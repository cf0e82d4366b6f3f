"""The Nyström map of the RBF kernel against the exact kernel, and its SVM against an exact kernel SVM."""

import numpy as np
import pytest

from surveyloom.operators import models

NAMES = ["a", "b"]


def rings(seed, n):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    angle, r = rng.uniform(0, 2 * np.pi, n), 1 + 1.2 * y + rng.normal(0, 0.35, n)
    return np.column_stack([r * np.cos(angle), r * np.sin(angle)]), y


def frame(spark, x, y):
    rows = [(i, float(a), float(b), float(c), 1.0) for i, ((a, b), c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "k long, a double, b double, y_index double, weight double")


def exact_svm(k, sign, rounds=400):
    """Dual coordinate ascent of the hinge loss with C = 1; the bias is one more feature."""
    q, alpha = (k + 1) * np.outer(sign, sign), np.zeros(len(k))
    for _ in range(rounds):
        for i in range(len(k)):
            alpha[i] = min(1.0, max(0.0, alpha[i] + (1 - q[i] @ alpha) / q[i, i]))
    return alpha * sign


def features(mapped):
    return np.array([r["features"].toArray() for r in mapped.orderBy("k").collect()])


def test_kernel_values(spark):
    x, y = rings(0, 400)
    df = frame(spark, x, y)
    fitted = models.fit_nystroem(df, NAMES, 0.5, key="k", size=64)
    phi = features(models.nystroem_map(df, NAMES, fitted, keep=["k"]))
    exact = models.rbf_kernel(x, x, 0.5)
    error = np.abs(phi @ phi.T - exact)
    # A lone point may be off by more than the mean; random waves are off everywhere.
    assert len(fitted.landmarks) == 64 and error.mean() < 0.005 and error.max() < 0.25
    waves = features(models.rbf_map(df, NAMES, 0.5, size=64, seed=1, keep=["k"]))
    assert error.mean() < 0.05 * np.abs(waves @ waves.T - exact).mean()
    again = models.fit_nystroem(df.repartition(7), NAMES, 0.5, key="k", size=64)
    assert np.array_equal(again.landmarks, fitted.landmarks)


def test_svm_agrees_with_the_exact_kernel(spark):
    x, y = rings(1, 400)
    z, truth = rings(2, 1_000)
    fitted = models.fit_nystroem(frame(spark, x, y), NAMES, 0.5, key="k", size=64)
    model = models.fit_svm(models.nystroem_map(frame(spark, x, y), NAMES, fitted, keep=["k", "y_index", "weight"]))
    scored = model.transform(models.nystroem_map(frame(spark, z, truth), NAMES, fitted, keep=["k"]))
    got = np.array([r["prediction"] for r in scored.orderBy("k").collect()])
    alpha = exact_svm(models.rbf_kernel(x, x, 0.5), 2 * y - 1)
    want = ((models.rbf_kernel(z, x, 0.5) + 1) @ alpha > 0).astype(float)
    assert (got == want).mean() >= 0.98
    assert (got == truth).mean() >= (want == truth).mean() - 0.01


def test_rare_region_gets_a_landmark(spark):
    x = np.vstack([np.random.default_rng(3).normal(0, 0.3, size=(2_000, 2)), [[9.0, 9.0]]])
    fitted = models.fit_nystroem(frame(spark, x, np.zeros(len(x))), NAMES, 0.5, key="k", size=30)
    assert (np.abs(fitted.landmarks - 9.0).max(axis=1) < 1e-9).any()


def test_odd_rows(spark):
    x = np.array([[1.0, 2.0]] * 50 + [[np.nan, 0.0]])
    fitted = models.fit_nystroem(frame(spark, x, np.zeros(len(x))), NAMES, 0.5, key="k", size=8)
    assert fitted.landmarks.tolist() == [[1.0, 2.0]] and fitted(np.array([[1.0, 2.0]]))[0] @ fitted(np.array([[1.0, 2.0]]))[0] == pytest.approx(1.0)
    with pytest.raises(ValueError):
        models.fit_nystroem(frame(spark, x, np.zeros(len(x))).where("isnan(a)"), NAMES, 0.5, key="k")
