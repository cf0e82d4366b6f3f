"""K-Means: restarts, sweep over k, elbow, final fit."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.functions import complete, cut_lineage, doubles, ident, local_table, quote
from surveyloom.operators.cluster.assign import ROWS_PER_TASK, block_slices, blocks, cluster_centres, distances, matrix, nearest_centroid, spread
from surveyloom.operators.cluster.quality import SilhouetteSample

#: Distinct points, at most, among which starting centres are drawn.
START_POINTS = 10_000


@dataclass(frozen=True)
class KMeansFit:
    """Centres, the cost of assigning every row to them, and the size and mean of each cluster."""

    centres: np.ndarray
    cost: float
    sizes: np.ndarray
    means: np.ndarray


def starting_points(df: DataFrame, columns: Sequence[str], n: int, seed: int) -> np.ndarray:
    """The ``n`` distinct complete points of smallest hash; each task sends at most ``n``."""
    names = list(columns)
    hashed = complete(doubles(df, names), names).withColumn("hash_", F.xxhash64(F.lit(seed), *[quote(c) for c in names]))

    def smallest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            if kept is not None and len(kept) == n:
                batch = batch[batch["hash_"] <= kept["hash_"].iloc[-1]]
            if kept is None or len(batch):
                kept = pd.concat([kept, batch]).drop_duplicates().nsmallest(n, "hash_")
        if kept is not None:
            yield kept

    drawn = hashed.mapInPandas(smallest, hashed.schema).distinct().orderBy("hash_", *[quote(c) for c in names]).limit(n)
    return matrix(drawn.toPandas(), names)


def spread_start(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """At most ``k`` distinct points, each drawn with its squared distance to those before."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(points)))]
    gap = ((points - points[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < k and gap.sum() > 0:
        chosen.append(int(rng.choice(len(points), p=gap / gap.sum())))
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The first of the nearest centres of each column of ``x`` (features × rows)."""
    far = (centres * centres).sum(axis=1)[:, None] / 2 - centres @ x
    best, near = far[0], np.zeros(x.shape[1], np.intp)
    for j in range(1, len(far)):
        closer = far[j] < best
        near[closer] = j
        best = np.minimum(best, far[j])
    return near


def _cluster_sums(
    data: DataFrame, columns: Sequence[str], models: dict[int, np.ndarray], *, exact: bool = False
) -> dict[int, np.ndarray]:
    """model → (k, 2 + d): rows, cost and feature sums of each cluster, all models in one scan of ``blocks``.

    Costs come from the sums of squares unless ``exact``.
    """
    wide = len(columns)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {m: np.zeros((len(c), wide + 2)) for m, c in models.items()}
        for x in block_slices(batches, wide):
            squares = (x * x).sum(axis=0)
            rows = np.vstack([np.ones(x.shape[1]), squares, x])
            for m, c in models.items():
                near = _nearest(x, c)
                if exact:
                    rows[1] = ((x - c.T[:, near]) ** 2).sum(axis=0)
                member = near == np.arange(len(c))[:, None]
                sums[m] += member.astype("float64") @ rows.T
        for m, s in sums.items():
            c = models[m]
            if not exact:
                s[:, 1] += s[:, 0] * (c * c).sum(axis=1) - 2 * (c * s[:, 2:]).sum(axis=1)
            used = np.flatnonzero(s[:, 0])
            yield pa.record_batch(
                [pa.array(np.full(len(used), m, np.int32)), pa.array(used.astype(np.int32)), *(pa.array(v) for v in s[used].T)],
                ["model", "cluster", *fields],
            )

    fields = [f"s{j}" for j in range(wide + 2)]
    merged = (
        data.mapInArrow(partial, "model int, cluster int, " + ", ".join(f"{f} double" for f in fields))
        .groupBy("model", "cluster")
        .agg(*[F.sum(f) for f in fields])
        .collect()  # one row per centre
    )
    found = {m: np.zeros((len(c), wide + 2)) for m, c in models.items()}
    for row in merged:
        found[row[0]][row[1]] = row[2:]
    return found


def lloyd(
    data: DataFrame, columns: Sequence[str], starts: Sequence[np.ndarray], *, max_iter: int = 300, tol: float = 0.0,
    gain: float = 1e-5,
) -> list[KMeansFit]:
    """Lloyd's iterations from each start over ``blocks``; every pass over the rows serves all starts still moving.

    A fit ends when its centres' squared shifts add up to ``tol`` or less, or a pass
    lowers its cost by no more than the share ``gain``. A centre that lost its rows stays where it is.
    One more pass gives the exact costs.
    """
    moving, last = dict(enumerate(starts)), {}
    ended: dict[int, np.ndarray] = {}
    for step in range(max_iter + 1):
        for m, s in _cluster_sums(data, columns, moving).items():
            sizes, centres = s[:, 0], moving[m]
            means = np.where(sizes[:, None] > 0, s[:, 2:] / np.maximum(sizes, 1)[:, None], centres)
            cost = max(float(s[:, 1].sum()), 0.0)
            settled = ((means - centres) ** 2).sum() <= tol or last.get(m, np.inf) - cost <= gain * cost
            last[m] = cost
            if step == max_iter or settled:
                ended[m] = moving.pop(m)
            else:
                moving[m] = means
        if not moving:
            break
    done = []
    for m, s in sorted(_cluster_sums(data, columns, ended, exact=True).items()):
        means = np.where(s[:, :1] > 0, s[:, 2:] / np.maximum(s[:, :1], 1), ended[m])
        done.append(KMeansFit(ended[m], float(s[:, 1].sum()), s[:, 0], means))
    return done


def best_kmeans(
    df: DataFrame, columns: Sequence[str], ks: Sequence[int], *, restarts: int = 10, seed: int = 42, max_iter: int = 300
) -> dict[int, KMeansFit]:
    """The cheapest of ``restarts`` fits for each k; all of them share the passes over one copy of the rows.

    With fewer distinct points than k, each point is its own cluster.
    """
    rows_per_task = max(ROWS_PER_TASK // (len(ks) * restarts), 1_000)  # each row meets every start
    rows = spread(cut_lineage(complete(doubles(df, columns), columns)), rows_per_task=rows_per_task)
    points = starting_points(rows, columns, START_POINTS, seed)
    data = blocks(rows, columns).persist()
    if not len(points):
        raise ValueError("no row without a null or NaN feature")
    starts = [(k, spread_start(points, k, seed + r)) for k in ks for r in range(restarts)]
    tol = 1e-4 * float(points.var(axis=0).mean())
    fits = lloyd(data, columns, [c for _, c in starts], max_iter=max_iter, tol=tol)
    data.unpersist()
    best: dict[int, KMeansFit] = {}
    for (k, _), fit in zip(starts, fits):
        if k not in best or fit.cost < best[k].cost:
            best[k] = fit
    return best


def kmeans_sweep(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    *,
    k_min: int = 2,
    k_max: int = 10,
    restarts: int = 10,
    seed: int = 42,
    silhouette_rows: int = 2_000,
) -> tuple[DataFrame, dict[int, KMeansFit]]:
    """(k, inertia, silhouette) for each k, and the fits."""
    sample = SilhouetteSample.draw(df, key, columns, silhouette_rows, seed)
    points = sample.matrix()
    fits = best_kmeans(df, columns, range(k_min, k_max + 1), restarts=restarts, seed=seed)
    scores = sample.scores({k: distances(points, f.centres).argmin(axis=1) for k, f in fits.items()})
    rows = [(k, f.cost, scores[k]) for k, f in fits.items()]
    return local_table(df.sparkSession, rows, "k int, inertia double, silhouette double"), fits


def elbow_k(series: DataFrame, *, k: str = "k", inertia: str = "inertia") -> DataFrame:
    """The k at the largest second difference of the inertia (first on a tie).

    The published rule adds one to the index of the largest second difference,
    which is the k of its middle point; so the two end points are never chosen.
    ``series`` has one row per candidate k.
    """
    w = Window.orderBy(k)
    bends = series.select(
        F.col(k).alias("k"),
        (F.lead(inertia).over(w) - 2 * F.col(inertia) + F.lag(inertia).over(w)).alias("bend"),
    )
    return bends.where("bend is not null").orderBy(F.desc("bend"), "k").limit(1)


def kmeans_fit(df: DataFrame, key: str, columns: Sequence[str], fit: KMeansFit) -> DataFrame:
    """(key, cluster) for every row; null where a feature is null or NaN."""
    return nearest_centroid(df, columns, fit.centres.tolist()).select(key, "cluster")


def within_sums(df: DataFrame, columns: Sequence[str], labellings: dict[int, str]) -> DataFrame:
    """(k, inertia) of given labellings: k → SQL text of the cluster id.

    Σ‖x − centre‖² per labelling from per-cluster counts, means and variances,
    all labellings in one pass.
    """
    clusters = ", ".join(f"struct({k} as k, cast({sql} as int) as cluster)" for k, sql in labellings.items())
    inertia = " + ".join(f"var_pop({ident(c)}) * count({ident(c)})" for c in columns)
    return (
        df.selectExpr(*[ident(c) for c in columns], f"inline(array({clusters}))")
        .groupBy("k", "cluster")
        .agg(F.expr(inertia).alias("w"))
        .groupBy("k")
        .agg(F.sum("w").alias("inertia"))
    )


__all__ = [
    "KMeansFit", "best_kmeans", "cluster_centres", "elbow_k", "kmeans_fit", "kmeans_sweep", "lloyd", "within_sums",
]
