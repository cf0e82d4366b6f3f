import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from surveyloom.operators import forest as forest_module
from surveyloom.operators.forest import (
    Plan, Tree, allowed, bootstrap, grow, grow_whole, joined_rows, node_table, packed_rows, ranked, unpacked_rows,
)


def table(spark, x, y, w=None):
    rows = [(i, [float(v) for v in a], float(b), 1.0 if w is None else float(w[i])) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "k long, x array<double>, y double, w double").select("k", array_to_vector("x").alias("features"), "y", "w")


def brute(x, y, w, classes, depth=None):
    """A tree by plain recursion over all thresholds: nested (feature, threshold, left, right) or the value."""
    sums = lambda i: np.array([w[i][y[i] == c].sum() for c in range(classes)]) if classes else np.array([(w[i] * y[i]).sum()])

    def node(i, d):
        s, total = sums(i), w[i].sum()
        best = None
        if len(set(y[i])) > 1 and d != 0:
            for f in range(x.shape[1]):
                for low, high in zip(sorted(set(x[i, f])), sorted(set(x[i, f]))[1:]):
                    left = i[x[i, f] <= low]
                    a, wa = sums(left), w[left].sum()
                    score = (a**2).sum() / wa + ((s - a) ** 2).sum() / (total - wa)
                    if best is None or score > best[0] * (1 + 1e-12):
                        best = (score, f, (low + high) / 2, left, i[x[i, f] > low])
        if best is None:
            return tuple(s / total)
        return best[1], best[2], node(best[3], None if d is None else d - 1), node(best[4], None if d is None else d - 1)

    return node(np.arange(len(y)), depth)


def nested(tree: Tree, i=0):
    if tree.left[i] < 0:
        return tuple(tree.value[i])
    k = tree.left[i]
    return int(tree.feature[i]), float(tree.threshold[i]), nested(tree, k), nested(tree, k + 1)


def same(a, b):
    if len(a) != 4 or len(b) != 4:
        return len(a) == len(b) and np.allclose(a, b)
    return a[0] == b[0] and np.isclose(a[1], b[1]) and same(a[2], b[2]) and same(a[3], b[3])


@pytest.mark.parametrize("classes", [0, 3])
def test_whole_tree_equals_brute_force(classes):
    rng = np.random.default_rng(1 + classes)
    for n in (1, 2, 40, 90):
        x = np.round(rng.normal(size=(n, 4)), 1)
        y = rng.integers(0, 3, n).astype(float) if classes else np.round(x[:, 0] + rng.normal(size=n), 1)
        w = rng.integers(1, 4, n).astype(float)
        tree = grow_whole(x, y, w, classes=classes)
        assert same(nested(tree), brute(x, y, w, classes))


@pytest.mark.parametrize("classes", [0, 3])
def test_levels_by_histograms(spark, classes):
    """Upper levels by shuffled histograms choose the brute-force splits where bins hold all values."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 12, (300, 3)).astype(float)
    y = rng.integers(0, 3, 300).astype(float) if classes else x[:, 1] * 2 + rng.normal(size=300)
    w = np.ones(300)
    forest = grow(table(spark, x, y).repartition(5), "y", Plan(classes=classes, whole=40, bins=64), key=F.col("k"))
    upper = forest.uppers[0].tree()
    assert (upper.left >= 0).sum() > 4
    got = brute(x, y - (0 if classes else y.mean()), w, classes)

    def splits(i, b):
        if upper.left[i] < 0:
            return
        # A threshold by bins is the value itself, by brute force the middle to the next one.
        assert upper.feature[i] == b[0] and upper.threshold[i] < b[1] <= upper.threshold[i] + 6
        rows = x[:, b[0]]
        assert ((rows <= upper.threshold[i]) == (rows <= b[1])).all() or len(set(rows)) < 12
        splits(upper.left[i], b[2])
        splits(upper.left[i] + 1, b[3])

    splits(0, got)
    rows = forest.transform(table(spark, x, y)).collect()
    exact = {tuple(a): set() for a in x}
    for a, b in zip(x, y):
        exact[tuple(a)].add(b)
    for r in rows:
        if len(exact[tuple(r.features.toArray())]) == 1:
            assert r.prediction == pytest.approx(r.y)


@pytest.mark.parametrize("whole", [10_000, 60])
def test_forest_by_broadcast_and_by_join(spark, whole):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] > 0) + (x[:, 1] > 0.5)).astype(float)
    plan = Plan(n_trees=12, draw=True, max_features=2, classes=3, seed=3, whole=whole, bins=32)
    forest = grow(table(spark, x, y), "y", plan, key=F.col("k"), trees_at_once=5)
    test = rng.normal(size=(300, 5))
    truth = ((test[:, 0] > 0) + (test[:, 1] > 0.5)).astype(float)
    df = table(spark, test, truth)
    sent = {r.k: r.prediction for r in forest.transform(df).collect()}
    joined = {r.k: r.prediction for r in forest.transform(df, broadcast_bytes=0).collect()}
    assert sent == joined and len(sent) == 300
    assert np.mean([sent[i] == truth[i] for i in range(300)]) > 0.85
    if whole == 10_000:  # no quantiles, so nothing depends on the layout
        again = grow(table(spark, x, y).repartition(7), "y", plan, key=F.col("k"))
        assert {r.k: r.prediction for r in again.transform(df).collect()} == sent
    assert forest.importances()[:2].sum() > 0.6 and forest.importances().sum() == pytest.approx(1)


def test_regression_forest_beats_a_tree(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 4))
    y = x[:, 0] * 3 + np.abs(x[:, 1]) + rng.normal(size=600)
    test = rng.normal(size=(400, 4))
    truth = test[:, 0] * 3 + np.abs(test[:, 1])
    error = {}
    for n, draw in ((1, False), (40, True)):
        forest = grow(table(spark, x, y), "y", Plan(n_trees=n, draw=draw, seed=1), key=F.col("k"))
        got = {r.k: r.prediction for r in forest.transform(table(spark, test, truth)).collect()}
        error[n] = np.mean([(got[i] - truth[i]) ** 2 for i in range(400)])
    assert error[40] < 0.6 * error[1]


def test_bootstrap_is_poisson():
    draws = bootstrap(np.arange(200_000), 3, 42)
    assert abs(draws.mean() - 1) < 0.01 and abs(draws.var() - 1) < 0.02
    assert not np.array_equal(draws, bootstrap(np.arange(200_000), 4, 42))


def test_edge_tables(spark):
    with pytest.raises(ValueError):
        grow(table(spark, [], []), "y", Plan(), key=F.col("k"))
    constant = grow(table(spark, [[1.0, 2.0]] * 5, [1, 2, 3, 4, 5]), "y", Plan(), key=F.col("k"))
    assert [r.prediction for r in constant.transform(table(spark, [[9.0, 9.0]], [0])).collect()] == [3.0]
    many = grow(table(spark, [[1.0]] * 50 + [[2.0]] * 50, [1.0] * 50 + [4.0] * 50), "y", Plan(whole=10), key=F.col("k"))
    assert {r.prediction for r in many.transform(table(spark, [[0.0], [3.0]], [0, 0])).collect()} == {1.0, 4.0}
    assert [r.value for r in node_table(many, ["a"]).collect()] == [2.5, 1.0, 4.0]
    nodes = node_table(grow(table(spark, [[1.0], [2.0], [3.0]], [0, 1, 1]), "y", Plan(classes=2), key=F.col("k")), ["a"]).collect()
    assert [(r.id, r.depth, r.feature, r.threshold, r.samples, r.value) for r in nodes] == [
        (0, 0, "a", 1.5, 3, 1.0), (1, 1, None, None, 1, 0.0), (2, 1, None, None, 2, 1.0),
    ]


def test_rows_travel_packed_and_whole():
    rng = np.random.default_rng(4)
    for distinct in (3, 300, 70_000):
        x = np.column_stack([rng.permutation(70_000) % distinct - 0.1, rng.integers(0, 5, 70_000)])
        rows = rng.choice(70_000, 500, replace=False)
        values, codes = ranked(x)
        raw = packed_rows(values, codes, rows)
        assert np.array_equal(unpacked_rows(raw, 2), x[rows])
        if distinct == 3:
            assert len(raw) < 500 * 2 * 2


def test_equal_splits_of_a_centred_target_go_to_the_first_feature(spark):
    """The second feature orders the rows backwards, so its sums are made in another order."""
    rng = np.random.default_rng(6)
    first = rng.integers(0, 9, 500).astype(float)
    y = rng.integers(0, 30, 500).astype(float)
    forest = grow(table(spark, np.column_stack([first, -first, first]), y), "y", Plan(), key=F.col("k"))
    assert {r.feature for r in node_table(forest, ["a", "b", "c"], max_depth=20).collect()} == {"a", None}


def test_large_subtrees_meet_rows_in_bounded_groups(spark):
    """Beyond the limit, counted unpacked, no task holds more than the limit or one subtree; results stay."""
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(size=(600, 3)), 2)
    y = np.round(x[:, 0] * 4 + rng.normal(size=600))
    forest = grow(table(spark, x, y), "y", Plan(n_trees=4, draw=True, whole=80, bins=16), key=F.col("k"))
    df = table(spark, np.round(rng.normal(size=(900, 3)), 2), np.zeros(900)).repartition(6)
    sent = {r.k: r.prediction for r in forest.transform(df).collect()}
    assert forest.subtrees.agg(F.max("nodes")).first()[0] * 8 * 7 < 10_000 < forest.subtrees.agg(F.sum("nodes")).first()[0] * 8 * 7
    for limit in (0, 10_000):
        got = {r.k: r.prediction for r in forest.transform(df, broadcast_bytes=limit).collect()}
        assert got.keys() == sent.keys() and all(got[i] == pytest.approx(sent[i]) for i in sent)


def test_nodes_look_at_their_drawn_features_and_are_dealt_over_tasks(spark, monkeypatch):
    """Upper nodes count cells of few features, split as with all in view, and no one task weighs them all."""
    rng = np.random.default_rng(8)
    x = rng.integers(0, 12, (6_000, 5)).astype(float)
    x[:, 1] = np.where(x[:, 0] > 6, x[:, 1], 3.0)  # varies only where the first feature is large
    x[:, 4] = 1.0
    y = ((x[:, 0] + x[:, 2] + rng.integers(0, 6, 6_000)) // 8).clip(0, 2)
    looked, hands, kept = [], [], forest_module._best_splits

    def watched(table, uppers, views, *more):
        found = kept(table, uppers, views, *more)
        looked.extend(map(len, views.values()))
        hands.append((len(views), found.rdd.getNumPartitions()))
        return found

    monkeypatch.setattr(forest_module, "_best_splits", watched)
    plan = Plan(n_trees=6, draw=True, max_features=2, classes=3, seed=5, whole=300)
    grown = grow(table(spark, x, y), "y", plan, key=F.col("k"))
    assert set(looked) >= {2, 4} and np.mean(looked) < 2.5
    assert all(n == min(v, 4 * spark.sparkContext.defaultParallelism) for v, n in hands) and max(hands)[0] > 8
    uid = {r.k: r.u for r in spark.range(6_000).selectExpr("id as k", "xxhash64(id) as u").collect()}
    uid = np.array([uid[i] for i in range(6_000)])
    for t, upper in enumerate(grown.uppers):
        of = {0: np.flatnonzero(bootstrap(uid, t, 5) > 0)}
        for node in sorted(upper.mean):
            rows, f = of[node], upper.feature[node]
            assert upper.mean[node][0] == len(rows)
            varies = x[rows].min(axis=0) < x[rows].max(axis=0)
            if f < 0:
                assert len(set(y[rows])) == 1 or not varies.any()
                continue
            assert allowed(np.array([upper.path[node]], np.uint64), varies[None], 2, 5)[0, f]
            right = x[rows, f] > upper.threshold[node]
            of[upper.left[node]], of[upper.left[node] + 1] = rows[~right], rows[right]


def test_joined_rows_are_those_of_each_part():
    rng = np.random.default_rng(9)
    x = rng.integers(0, 40, (500, 3)).astype(float)
    x[:, 2] /= 7
    parts = [packed_rows(*ranked(some), np.arange(0, len(some), 2)) for some in (x[:200], x[200:])]
    values, codes = joined_rows(parts, 3)
    assert np.array_equal(np.stack([v[c] for v, c in zip(values, codes)], axis=1), np.concatenate([x[:200:2], x[200::2]]))


@pytest.mark.parametrize("classes", [0, 3])
def test_many_ranked_rows_summed_feature_by_feature_equal_brute_force(classes):
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=(600, 3)), 1)
    x[:, 2] = np.where(x[:, 0] > 0, x[:, 2], 0.5)  # may not be used where it does not vary
    y = rng.integers(0, 3, 600).astype(float) if classes else np.round(4 * x[:, 0] + rng.normal(size=600))
    w = rng.integers(1, 4, 600).astype(float)
    assert same(nested(grow_whole(ranked(x), y, w, classes=classes, max_depth=6)), brute(x, y, w, classes, 6))
