"""Clusterings against brute force on small fixtures."""

import numpy as np
import pytest

from surveyloom.operators import cluster, reduce
from surveyloom.operators.cluster.density import connected_components
from surveyloom.operators.cluster.fuzzy import membership_columns
from surveyloom.operators.cluster.hierarchical import ward_merge
from surveyloom.plans.unsupervised import cluster_scatter


def table(spark, x):
    names = [f"x{j}" for j in range(x.shape[1])]
    ddl = "k long, " + ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ddl), names


def blobs(seed=0, n=40, centres=((0, 0), (6, 0), (0, 6))):
    rng = np.random.default_rng(seed)
    return np.vstack([rng.normal(c, 0.6, size=(n, 2)) for c in centres]), np.repeat(range(len(centres)), n)


def brute_dbscan(x, eps, m):
    near = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) <= eps
    core = near.sum(1) >= m
    label = np.where(core, np.arange(len(x)), -1)
    changed = True
    while changed:
        changed = False
        for i in np.flatnonzero(core):
            low = label[near[i] & core].min()
            if low < label[i]:
                label[i], changed = low, True
    for i in np.flatnonzero(~core):
        reach = near[i] & core
        if reach.any():
            label[i] = label[reach].min()
    order = {v: c for c, v in enumerate(sorted(set(label[label >= 0])))}
    return [order.get(v, -1) for v in label]


@pytest.mark.parametrize("block", [2_048, 16])
def test_dbscan_equals_brute_force_with_copies_and_small_blocks(spark, block):
    x, _ = blobs(n=30)
    x = np.vstack([x, np.repeat(x[:1], 40, axis=0), [[20, 20], [3, 3]]])  # a hot copied point, noise
    df, names = table(spark, x)
    got = {r[0]: r[1] for r in cluster.dbscan(df, "k", names, 0.5, block=block).collect()}
    assert [got[i] for i in range(len(x))] == brute_dbscan(x, 0.5, 5)


def test_rows_without_a_feature_are_noise_and_without_a_centre(spark):
    x, _ = blobs(n=10)
    x = np.vstack([x, [[np.nan, 0.0], [1.0, np.nan]]])
    df, names = table(spark, x)
    df = df.selectExpr("k", "if(k = 31, null, x0) as x0", "x1")
    got = {r[0]: r[1] for r in cluster.dbscan(df, "k", names, 1.5).collect()}
    assert len(got) == len(x) and got[30] == got[31] == -1
    few, many = [[0.0, 0.0], [6.0, 0.0]], [[0.0, 0.0], [6.0, 0.0]] + [[50.0 + i, 50.0] for i in range(120)]
    for centres in (few, many):  # SQL text, and batches
        near = {r["k"]: r["cluster"] for r in cluster.nearest_centroid(df, names, centres).collect()}
        assert near[30] is None and near[31] is None and near[0] == 0 and near[10] == 1
    fit = cluster.kmeans_sweep(df, "k", names, k_max=3)[1][3]
    labels = {r[0]: r[1] for r in cluster.kmeans_fit(df, "k", names, fit).collect()}
    assert labels[30] is None and fit.sizes.sum() == 30


def test_kmeans_sums_match_the_assigned_rows_and_copies_need_fewer_centres(spark):
    x, _ = blobs(seed=4, n=30)
    df, names = table(spark, x)
    fit = cluster.partition.best_kmeans(df, names, [4])[4]
    near = ((x[:, None] - fit.centres) ** 2).sum(-1)
    assert fit.cost == pytest.approx(near.min(axis=1).sum())
    assert fit.sizes.tolist() == np.bincount(near.argmin(axis=1), minlength=4).tolist()
    df, names = table(spark, np.repeat([[0.0, 1.0], [5.0, 5.0]], 20, axis=0))
    fit = cluster.partition.best_kmeans(df, names, [4])[4]
    assert fit.cost == 0 and sorted(fit.sizes) == [20, 20]


def test_ward_of_few_distinct_points_is_exact(spark):
    x = np.array([[0.0, 0], [0.2, 0], [5, 5], [5.1, 5], [9, 0], [9.3, 0]])
    df, names = table(spark, np.repeat(x, 200, axis=0))  # more rows than micro-clusters
    found = {r[0]: r[1] for r in cluster.agglomerative(df, "k", names, 3).collect()}
    assert len(set(found.values())) == 3 and all(len({found[i] for i in range(400 * g, 400 * g + 400)}) == 1 for g in range(3))


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).selectExpr("id as pid", "id + 1 as other")
    labels = {r[0]: r[1] for r in connected_components(edges).collect()}
    assert labels == {i: 0 for i in range(61)}


def test_silhouette_and_davies_bouldin(spark):
    x, y = blobs(n=20)
    df, names = table(spark, x)
    df = df.withColumn("c", (df.k / 20).cast("int"))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    s = []
    for i in range(len(x)):
        a = d[i][y == y[i]].sum() / 19
        b = min(d[i][y == c].mean() for c in set(y) - {y[i]})
        s.append((b - a) / max(a, b))
    assert cluster.silhouette(df, "k", names, "c") == pytest.approx(np.mean(s), abs=1e-12)
    m = np.array([x[y == c].mean(0) for c in range(3)])
    w = np.array([np.sqrt(((x[y == c] - m[c]) ** 2).sum(1)).mean() for c in range(3)])
    r = [max((w[i] + w[j]) / np.sqrt(((m[i] - m[j]) ** 2).sum()) for j in range(3) if j != i) for i in range(3)]
    assert cluster.davies_bouldin(df, names, "c") == pytest.approx(np.mean(r), abs=1e-12)


def test_summary_has_nulls_for_one_cluster_and_counts_noise(spark):
    x, _ = blobs(n=10)
    df, names = table(spark, x)
    one = cluster.cluster_summary(df.selectExpr("*", "0 as c"), "k", names, "c")
    assert one == {"N_Clusters": 1, "Silhouette": None, "Davies_Bouldin": None}
    noisy = cluster.cluster_summary(df.selectExpr("*", "cast(k / 10 as int) - 1 as c"), "k", names, "c", noise=-1)
    assert noisy["N_Clusters"] == 2 and noisy["N_Noise"] == 10 and noisy["Silhouette"] > 0.5


def test_memberships_sum_to_one_and_a_centre_owns_itself(spark):
    df, names = table(spark, np.array([[0.0, 0.0], [1.0, 0.5], [4.0, 4.0]]))
    got = {r[0]: r[1:] for r in membership_columns(df, "k", names, [[0.0, 0.0], [4.0, 4.0]]).collect()}
    assert all(abs(sum(u) - 1) < 1e-12 for u in got.values())
    assert got[0] == (1.0, 0.0) and got[2] == (0.0, 1.0)


def test_fuzzy_kmeans_and_ward_find_the_blobs(spark):
    x, y = blobs(n=25)
    df, names = table(spark, x)
    sweep, models = cluster.kmeans_sweep(df, "k", names, k_max=5)
    cost = [r["inertia"] for r in sweep.orderBy("k").collect()]
    assert cost[0] > cost[1]
    assert cluster.elbow_k(sweep).first()["k"] == 3
    for labels in (
        cluster.kmeans_fit(df, "k", names, models[3]),
        cluster.fuzzy_cmeans(df, "k", names, 3)[0],
        cluster.agglomerative(df, "k", names, 3),
        cluster.agglomerative(df, "k", names, 3, micro=12),
    ):
        found = {r[0]: r[1] for r in labels.collect()}
        assert len(found) == len(x)
        assert {len({found[i] for i in np.flatnonzero(y == c)}) for c in range(3)} == {1}


def test_ward_respects_sizes():
    centres, sizes = np.array([[0.0], [1.0], [2.2]]), np.array([100.0, 100.0, 1.0])
    assert ward_merge(centres, sizes, 2).tolist() == [0, 1, 1]


def test_subtractive_follows_the_greedy_rule(spark):
    x, _ = blobs(n=30)
    df, names = table(spark, x)
    p = cluster.subtractive_potential(df, "k", names, radius=2.0)
    brute = np.exp(-1.0 * ((x[:, None] - x[None]) ** 2).sum(-1)).sum(1)
    assert np.allclose([r["potential"] for r in p.orderBy("k").collect()], brute)
    centres = cluster.subtractive_centres(p, "k", names, r_a=2.0, r_b=3.0)
    assert centres[0] == x[brute.argmax()].tolist() and len(centres) == 3


def test_relabel_spacing_and_limit(spark):
    from surveyloom.operators.cluster.relabel import spaced_labels

    assert spaced_labels(2) == ["Minimal", "Severe"]
    assert spaced_labels(3) == ["Minimal", "Moderate", "Severe"]
    assert spaced_labels(4) == ["Minimal", "Mild", "Moderately_Severe", "Severe"]
    with pytest.raises(ValueError):
        spaced_labels(6)


def test_pca_scores_have_the_explained_variance(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 4)) @ rng.normal(size=(4, 4))
    df, names = table(spark, x)
    scores, explained = reduce.pca_project(df.selectExpr("*", "1.0 as flat"), "k", [*names, "flat"], 3)
    z = (x - x.mean(0)) / x.std(0)
    values = np.sort(np.linalg.eigvalsh(np.cov(z.T)))[::-1]
    got = [r["percent"] for r in explained.orderBy("component").collect()]
    assert np.allclose(got, values[:3] / values.sum() * 100)
    var = scores.selectExpr("var_samp(pc1)", "var_samp(pc2)", "var_samp(pc3)").first()
    assert np.allclose(var, values[:3])


def test_blocks_hold_every_complete_row_and_costs_are_exact(spark):
    """Passes read packed blocks: no row is lost, incomplete ones take no part, and points on centres cost nothing."""
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(9_000, 3)) * 4 + 1e4)
    rows = [tuple(map(float, r)) for r in x] + [(None, 1.0, 2.0), (float("nan"), 1.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(3)
    packed = cluster.assign.blocks(df, ["a", "b", "c"], rows=700)
    got = np.concatenate([np.frombuffer(r.block, np.float64).reshape(3, -1).T for r in packed.collect()])
    assert sorted(map(tuple, got)) == sorted(map(tuple, x))
    fit = cluster.partition.best_kmeans(df, ["a", "b", "c"], [4], restarts=2)[4]
    far = ((x[:, None] - fit.centres) ** 2).sum(axis=2)
    assert fit.cost == pytest.approx(far.min(axis=1).sum(), rel=1e-12) and fit.sizes.sum() == 9_000
    few = spark.createDataFrame([(1e6 + v, 0.1) for v in (1.0, 2.0, 3.0)] * 50, "a double, b double")
    assert cluster.partition.best_kmeans(few, ["a", "b"], [3], restarts=2)[3].cost == 0
    shares = [cluster.fuzzy.memberships(x[:50], x[:3], m) for m in (2, 2 + 1e-12)]
    assert np.allclose(*shares) and np.array_equal(shares[0][:3].argmax(axis=1), [0, 1, 2])


def test_cluster_scatter_holds_every_row(spark):
    """More rows than plots are capped at: each is there once with its label."""
    n = 60_000
    df = spark.range(n).selectExpr("id as resp_id", "cast(id % 7 as double) as a", "cast(id * 13 % 11 as double) as b", "0 as phq9_total")
    labels = df.selectExpr("resp_id", "cast(resp_id % 3 as int) - 1 as KMeans")
    got = cluster_scatter(df, labels).selectExpr("resp_id", "label = element_at(array('Noise', 'Cluster 0', 'Cluster 1'), cast(resp_id % 3 as int) + 1) as right")
    assert got.count() == got.select("resp_id").distinct().count() == got.where("right").count() == n
