import numpy as np
import pytest

from surveyloom.operators.cluster import density
from tests.test_clustering import brute_dbscan


def test_distances_by_product_equal_those_by_terms(monkeypatch):
    rng = np.random.default_rng(3)
    grid = rng.integers(0, 4, (300, 6)) / 10.0  # very many pairs lie at ε but for rounding
    for x, eps in ((grid, 0.2), (grid + 1e6, 0.2), (rng.normal(size=(300, 64)), 11.0), (np.zeros((5, 2)), 0.5)):
        expected = np.sqrt(density._sq_distances(x[:200], x)) <= eps
        with monkeypatch.context() as m:
            m.setattr(density, "_sq_distances", None)  # rows times columns times dimensions in slow passes
            assert (density._near(x[:200], x, eps) == expected).all()
    far = np.array([[np.inf, 1.0], [0.0, 1.0], [1e200, 0.0]])
    assert density._near(far, far, 1.0).tolist() == [[False] * 3, [False, True, False], [False, False, True]]


def test_cuts_in_gaps_send_no_margin(spark):
    rng = np.random.default_rng(4)
    x = np.hstack([rng.integers(0, 6, (3000, 3)).astype(float), rng.normal(size=(3000, 1))])
    df = spark.createDataFrame([(i, 1, *map(float, v)) for i, v in enumerate(x)], "pid long, w long, x0 double, x1 double, x2 double, x3 double")
    sent = density._blocks(df, ["x0", "x1", "x2", "x3"], 0.5, 200, 1, len(x))
    assert sent.select("pid", "leaf").distinct().count() < 1.2 * len(x)
    assert sent.where("home").select("pid").distinct().count() == len(x)


@pytest.mark.parametrize("block", [40, 5000])
def test_steps_and_slopes_equal_brute_force(spark, block):
    rng = np.random.default_rng(5)
    x = np.hstack([rng.integers(0, 3, (400, 2)) * 0.5, rng.normal(size=(400, 1)), rng.integers(0, 2, (400, 1)) * 3.0])
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "k long, x0 double, x1 double, x2 double, x3 double")
    for eps in (0.1, 0.5):
        got = {r[0]: r[1] for r in density.dbscan(df, "k", ["x0", "x1", "x2", "x3"], eps, block=block).collect()}
        assert [got[i] for i in range(len(x))] == brute_dbscan(x, eps, 5)
