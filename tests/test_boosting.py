import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array

from surveyloom.operators.boosting import _packed, exact_edges, fit_softmax_boosting, fit_squared_boosting
from surveyloom.operators.forest import grow_whole


def table(spark, x, y):
    rows = [(i, [float(v) for v in a], float(b)) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "k long, x array<double>, y double").select("k", array_to_vector("x").alias("features"), "y")


def plain(x, y, classes, rounds, depth=3, rate=0.1):
    """Softmax boosting in numpy, on exact trees: the probabilities of the training rows."""
    scores = np.tile(np.log(np.bincount(y, minlength=classes) / len(y)), (len(y), 1))
    for _ in range(rounds):
        p = np.exp(scores - scores.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        step = np.zeros_like(scores)
        for k in range(classes):
            r = (y == k) - p[:, k]
            leaf = (tree := grow_whole(x, r, np.ones(len(y)), max_depth=depth)).route(x)
            for i in set(leaf):
                own = leaf == i
                bottom = (np.abs(r[own]) * (1 - np.abs(r[own]))).sum()
                step[own, k] = rate * (classes - 1) / classes * r[own].sum() / bottom
            assert tree.left[0] >= 0
        scores = scores + step
    p = np.exp(scores - scores.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def loss(p, y):
    return -np.log(p[np.arange(len(y)), y]).mean()


@pytest.mark.parametrize("classes", [2, 4])
def test_equals_numpy(spark, classes):
    rng = np.random.default_rng(classes)
    x = rng.normal(size=(150, 4))
    y = np.digitize(x[:, 0] + 0.5 * x[:, 1] + 0.3 * rng.normal(size=150), np.linspace(-1, 1, classes - 1) if classes > 2 else [0.0])
    df = table(spark, x, y).repartition(3)
    expected = plain(x, y, classes, 8)
    model = fit_softmax_boosting(df, "y", classes, rounds=8)
    got = np.array([r.probability for r in model.transform(df).orderBy("k").collect()])
    assert np.allclose(got, expected, atol=1e-9)
    assert loss(got, y) == pytest.approx(loss(expected, y), abs=1e-9) and loss(got, y) < 0.7 * loss(np.full_like(got, 1 / classes), y)


def test_jobs_equal_one_task(spark):
    """Values few enough for a bin each: both ways choose the same splits of the training rows."""
    rng = np.random.default_rng(9)
    x = rng.integers(0, 9, (400, 3)).astype(float)
    y = ((x[:, 0] > 4).astype(int) + (x[:, 1] + rng.normal(size=400) > 5)).astype(int)
    df = table(spark, x, y).repartition(4)
    one = fit_softmax_boosting(df, "y", 3, rounds=12, bins=32)
    jobs = fit_softmax_boosting(df, "y", 3, rounds=12, bins=32, whole=0)
    a, b = (np.array([r.probability for r in m.transform(df).orderBy("k").collect()]) for m in (one, jobs))
    assert np.allclose(a, b, atol=1e-9)
    assert [r.prediction for r in one.transform(df).orderBy("k").collect()] == a.argmax(axis=1).tolist()


def test_edges(spark):
    assert [e.tolist() for e in exact_edges(np.array([[1.0, 5.0], [2.0, 5.0], [4.0, 5.0]]), 8)] == [[1.5, 3.0], []]
    assert len(exact_edges(np.arange(1000.0)[:, None], 16)[0]) == 15
    with pytest.raises(ValueError):
        fit_softmax_boosting(table(spark, [], []), "y", 2)
    lone = fit_softmax_boosting(table(spark, [[1.0]] * 4, [0, 0, 0, 1]), "y", 2, rounds=3)
    assert lone.transform(table(spark, [[7.0]], [0])).first().prediction == 0.0


def test_numbers_equal_exact_trees(spark):
    """The first tree takes the numbers whole, a later one a fifth of what is left; jobs and one task agree."""
    rng = np.random.default_rng(11)
    x = rng.integers(0, 9, (500, 3)).astype(float)
    y = 3 * (x[:, 0] > 4) + x[:, 1] + rng.normal(size=500)
    df, left, expected = table(spark, x, y).repartition(4), y.copy(), np.zeros(500)
    for i in range(12):
        leaf = grow_whole(x, left, np.ones(500), max_depth=3).route(x)
        means = np.array([left[leaf == v].mean() for v in leaf])
        expected += means * (0.2 if i else 1.0)
        left = y - expected
    for whole in (20_000, 0):
        model = fit_squared_boosting(df, "y", rounds=12, bins=32, whole=whole)
        got = [r.prediction for r in model.transform(df).orderBy("k").collect()]
        assert np.allclose(got, expected, atol=1e-9)


def test_rows_travel_as_blocks_of_bin_numbers(spark):
    """A pass reads a few packed rows: one byte a feature, however many rows the table has."""
    x = np.random.default_rng(2).normal(size=(1000, 3))
    rows = table(spark, x, [0] * 1000).select(vector_to_array("features").alias("x"), "y").repartition(2)
    blocks = _packed(rows, 3, [np.array([-0.5, 0.5])] * 3, np.zeros(2)).collect()
    assert len(blocks) == 2 and sum(len(b.codes) for b in blocks) == 3000 and sum(len(b.scores) for b in blocks) == 16_000
