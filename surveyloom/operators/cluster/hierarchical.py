"""Agglomerative (Ward) clustering of all rows through mergeable clustering features.

A clustering feature is a size and a mean.  Each task condenses its rows in one
scan: a row joins the nearest feature where that costs no more than the merges
already made, else it becomes a feature of its own, and when there are too many
the cheapest merges are made.  Features of several tasks are condensed the same
way, some tasks at a time, until one bounded set is left; its Ward tree labels it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import complete, cut_lineage, doubles, ident
from surveyloom.operators.cluster.assign import matrix, nearest_centroid, spread

#: Features a set is condensed to; sets of features condensed together.
MICRO_CLUSTERS, FAN_IN = 500, 4
#: Entries of a distance block.
BLOCK_ENTRIES = 2_000_000


def merge_costs(x: np.ndarray, n: np.ndarray, y: np.ndarray, m: np.ndarray) -> np.ndarray:
    """How much merging each of ``x`` with each of ``y`` raises the within-cluster sum of squares.

    Summed column by column, so that the cost of (a, b) is that of (b, a) to the last bit.
    """
    d = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        d += (x[:, j, None] - y[None, :, j]) ** 2
    return d * (n[:, None] * m[None, :] / (n[:, None] + m[None, :]))


def _cheapest(c: np.ndarray, n: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each feature's cheapest partner and its cost; ties by a drawn order of pairs, the same from both sides."""
    partner, cost = np.empty(len(c), dtype=np.int64), np.empty(len(c))
    step = max(1, BLOCK_ENTRIES // len(c))
    for a in range(0, len(c), step):
        rows = np.arange(a, min(a + step, len(c)))
        block = merge_costs(c[rows], n[rows], c, n)
        block[rows - a, rows] = np.inf
        low = block.min(axis=1)
        partner[rows], cost[rows] = block.argmin(axis=1), low
        # Ties are few but for lattice-like data, where the draw keeps the rounds few.
        ties = block == low[:, None]
        many = np.flatnonzero(ties.sum(axis=1) > 1)
        if len(many):
            order = np.where(ties[many], draw[rows[many], None] ^ draw[None, :], np.iinfo(np.int64).max)
            partner[rows[many]] = order.argmin(axis=1)
    return partner, cost


def ward_tree(centres: np.ndarray, sizes: np.ndarray, *, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, costs) of all merges of the Ward tree, each pair naming one member of either side.

    Every round merges all pairs that are each other's cheapest partners. Ward's
    costs never fall after a merge, so the tree is that of merging one cheapest
    pair at a time, and its cheapest merges are its first ones.
    """
    c, n = centres.astype("float64"), sizes.astype("float64")
    draw = np.random.default_rng(seed).permutation(1 << 20)[: len(c)] if len(c) <= 1 << 20 else np.arange(len(c))
    name = np.arange(len(c))
    pairs, costs = [], []
    while len(c) > 1:
        partner, cost = _cheapest(c, n, draw)
        low = np.flatnonzero((partner[partner] == np.arange(len(c))) & (np.arange(len(c)) < partner))
        high = partner[low]
        pairs.append(np.column_stack([name[low], name[high]]))
        costs.append(cost[low])
        total = n[low] + n[high]
        c[low] += (c[high] - c[low]) * (n[high] / total)[:, None]  # equal means stay as they are
        n[low] = total
        stay = np.ones(len(c), dtype=bool)
        stay[high] = False
        c, n, name, draw = c[stay], n[stay], name[stay], draw[stay]
    if not pairs:
        return np.zeros((0, 2), dtype=np.int64), np.zeros(0)
    return np.concatenate(pairs), np.concatenate(costs)


def ward_merge(centres: np.ndarray, sizes: np.ndarray, k: int, *, seed: int = 42) -> np.ndarray:
    """Ward labels of weighted centres, numbered by first member."""
    return _cut(centres, sizes, k, seed)[0]


def _cut(centres: np.ndarray, sizes: np.ndarray, k: int, seed: int) -> tuple[np.ndarray, float]:
    """Labels of the tree cut at ``k`` clusters, and the cost of the last merge made."""
    pairs, costs = ward_tree(centres, sizes, seed=seed)
    made = np.argsort(costs, kind="stable")[: max(0, len(centres) - k)]
    root = list(range(len(centres)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs[made]:
        a, b = sorted((find(int(a)), find(int(b))))
        root[b] = a
    top = np.array([find(i) for i in range(len(centres))], dtype=np.int64)
    return np.unique(top, return_inverse=True)[1], float(costs[made].max(initial=0.0))


def condense(centres: np.ndarray, sizes: np.ndarray, most: int, *, seed: int = 42) -> tuple[np.ndarray, np.ndarray, float]:
    """At most ``most`` features of the same rows, and the cost of the dearest merge; equal means are one feature."""
    x, at = np.unique(centres + 0.0, axis=0, return_inverse=True)
    n = np.bincount(at.ravel(), weights=sizes, minlength=len(x))
    if len(x) <= most:
        return x, n, 0.0
    label, dearest = _cut(x, n, most, seed)
    total = np.bincount(label, weights=n)
    # A feature that merged with no other keeps its mean to the last bit.
    means = np.column_stack([np.bincount(label, weights=n * x[:, j]) / total for j in range(x.shape[1])])
    alone = np.bincount(label)[label] == 1
    means[label[alone]] = x[alone]
    return means, total, dearest


def features_of(df: DataFrame, columns: Sequence[str], micro: int, *, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """(means, sizes) of at most ``micro`` clustering features of all rows without null or NaN."""
    names = list(columns)
    inside = [f"x{j}_" for j in range(len(names))]
    schema = "piece_ long, n_ double, " + ", ".join(f"{x} double" for x in inside)

    def table(piece: int, x: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame(x, columns=inside).assign(piece_=piece, n_=n)[["piece_", "n_", *inside]]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        x, n, limit = np.zeros((0, len(inside))), np.zeros(0), 0.0
        for batch in batches:
            rows = matrix(batch, inside)
            for a in range(0, len(rows), micro):
                new, count, _ = condense(rows[a : a + micro], np.ones(len(rows[a : a + micro])), micro, seed=seed)
                if limit > 0:  # some rows cost no more to take in than the merges made so far
                    apart = np.maximum((new * new).sum(axis=1)[:, None] + (x * x).sum(axis=1) - 2 * new @ x.T, 0)
                    cost = apart * (count[:, None] * n / (count[:, None] + n))
                    near = cost.argmin(axis=1)
                    close = cost[np.arange(len(new)), near] <= limit
                    taken = np.bincount(near[close], weights=count[close], minlength=len(x))
                    moved = np.zeros_like(x)
                    np.add.at(moved, near[close], (new[close] - x[near[close]]) * count[close, None])
                    n = n + taken
                    x = x + moved / n[:, None]
                    new, count = new[~close], count[~close]
                x, n = np.vstack([x, new]), np.concatenate([n, count])
                if len(x) > 2 * micro:
                    x, n, dearest = condense(x, n, micro, seed=seed)
                    limit = max(limit, dearest)
        if len(x):
            x, n, _ = condense(x, n, micro, seed=seed)
            yield table(TaskContext.get().partitionId(), x, n)

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        x, n, _ = condense(matrix(pdf, inside), pdf["n_"].to_numpy(), micro, seed=seed)
        return table(int(pdf["piece_"].iloc[0]) // FAN_IN, x, n)

    rows = complete(doubles(df, names), names).selectExpr(*[f"{ident(c)} as {x}" for c, x in zip(names, inside)])
    found = cut_lineage(spread(rows).mapInPandas(scan, schema))
    last = found.agg(F.max("piece_")).first()[0]
    while last:
        found = cut_lineage(found.groupBy(F.expr(f"piece_ div {FAN_IN}")).applyInPandas(joined, schema))
        last //= FAN_IN
    # One piece is left: at most ``micro`` rows.
    held = found.toPandas().sort_values(inside)
    return matrix(held, inside), held["n_"].to_numpy()


def agglomerative(
    df: DataFrame, key: str, columns: Sequence[str], k: int, *, micro: int = MICRO_CLUSTERS, seed: int = 42
) -> DataFrame:
    """(key, cluster): Ward of at most ``micro`` clustering features of all rows.

    Up to ``micro`` distinct points are features of their own, so the merge is then
    exact; beyond, the features follow the order in which tasks read their rows. A
    row with a null or NaN feature has a null cluster.
    """
    means, sizes = features_of(df, columns, micro, seed=seed)
    if not len(means):
        return df.select(key, F.lit(None).cast("int").alias("cluster"))
    merged = F.array(*[F.lit(int(c)) for c in ward_merge(means, sizes, k, seed=seed)])
    near = nearest_centroid(spread(df), columns, means.tolist(), out="micro_")
    # Folded into the search for the nearest centre, a plain index would also be tried where there is none.
    return near.select(key, F.get(merged, F.col("micro_")).alias("cluster"))
