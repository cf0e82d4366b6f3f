"""Ward trees by reciprocal neighbours against one greedy merge at a time; clustering features against all rows."""

import numpy as np
import pytest

from surveyloom.operators import cluster
from surveyloom.operators.cluster import hierarchical as H


def greedy(x, n, k):
    """Labels of merging the cheapest pair until ``k`` clusters are left."""
    c, n = x.astype(float).copy(), n.astype(float).copy()
    group = np.arange(len(c))
    cost = H.merge_costs(c, n, c, n)
    np.fill_diagonal(cost, np.inf)
    for _ in range(len(c) - k):
        i, j = sorted(np.unravel_index(cost.argmin(), cost.shape))
        c[i], n[i] = (n[i] * c[i] + n[j] * c[j]) / (n[i] + n[j]), n[i] + n[j]
        group[group == j] = i
        n_ = np.where(np.isin(np.arange(len(c)), group), n, np.nan)
        fresh = ((c - c[i]) ** 2).sum(axis=1) * (n_ * n[i] / (n_ + n[i]))
        fresh[[i, j]] = np.inf
        cost[i], cost[:, i] = np.nan_to_num(fresh, nan=np.inf), np.nan_to_num(fresh, nan=np.inf)
        cost[j], cost[:, j] = np.inf, np.inf
    return np.unique(group, return_inverse=True)[1]


def same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def spent(x, label):
    return sum(((x[label == c] - x[label == c].mean(axis=0)) ** 2).sum() for c in set(label))


def frame(spark, x):
    names = [f"x{j}" for j in range(x.shape[1])]
    ddl = "k long, " + ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ddl), names


@pytest.mark.parametrize("k", [1, 2, 7, 60])
def test_tree_equals_greedy_merging(k):
    rng = np.random.default_rng(k)
    x, n = rng.normal(size=(250, 3)), rng.integers(1, 50, 250)
    assert same_partition(H.ward_merge(x, n, k), greedy(x, n, k))


def test_lattice_needs_few_rounds(monkeypatch):
    x = np.stack(np.meshgrid(range(20), range(20)), axis=-1).reshape(-1, 2).astype(float)
    rounds, plain = [], H._cheapest
    monkeypatch.setattr(H, "_cheapest", lambda *a: (rounds.append(1), plain(*a))[1])
    pairs, costs = H.ward_tree(x, np.ones(400))
    assert len(pairs) == len(costs) == 399 and len(rounds) < 60


def test_exact_on_2000_distinct_points(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2_000, 4)) + rng.integers(0, 4, size=(2_000, 1)) * 2
    df, names = frame(spark, np.vstack([x, x[:500]]))
    found = {r[0]: r[1] for r in cluster.agglomerative(df.repartition(5), "k", names, 5, micro=2_000).collect()}
    got = np.array([found[i] for i in range(2_000)])
    sizes = np.where(np.arange(2_000) < 500, 2, 1)
    assert same_partition(got, greedy(x, sizes, 5)) and all(found[2_000 + i] == found[i] for i in range(500))


def test_condensed_rows_keep_their_sums_and_cost_little(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(c, 1, size=(1_500, 3)) for c in ((0, 0, 0), (7, 0, 0), (0, 7, 7))])
    df, names = frame(spark, x)
    means, sizes = H.features_of(df.repartition(20), names, 60)
    assert len(means) <= 60 and sizes.sum() == len(x)
    assert np.allclose(sizes @ means, x.sum(axis=0), rtol=1e-9)
    found = {r[0]: r[1] for r in cluster.agglomerative(df.repartition(20), "k", names, 3, micro=60).collect()}
    label, truth = np.array([found[i] for i in range(len(x))]), np.repeat(range(3), 1_500)
    assert spent(x, label) <= 1.02 * spent(x, truth)


def test_odd_rows(spark):
    df, names = frame(spark, np.array([[0.0, 0], [0, 0], [9, 9], [np.nan, 1]]))
    found = {r[0]: r[1] for r in cluster.agglomerative(df.unionByName(df.selectExpr("4L k", "cast(null as double) x0", "x1").limit(1)), "k", names, 2).collect()}
    assert found[0] == found[1] != found[2] and found[3] is None and found[4] is None
    assert cluster.agglomerative(df.limit(0), "k", names, 2).count() == 0
    assert [r[1] for r in cluster.agglomerative(df.where("k = 3"), "k", names, 2).collect()] == [None]
