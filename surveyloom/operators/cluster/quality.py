"""Cluster quality: silhouette, Davies-Bouldin, and the summary row."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import doubles, ident, local_table, quote, value_or_null
from surveyloom.operators.cluster.assign import as_vectors, cluster_centres, matrix
from surveyloom.operators.sampling import sample_n


@dataclass
class SilhouetteSample:
    """A bounded row sample whose points are broadcast once, for many scorings."""

    rows: DataFrame
    columns: tuple[str, ...]
    points: pd.DataFrame

    @classmethod
    def draw(cls, df: DataFrame, key: str, columns: Sequence[str], n: int, seed: int) -> SilhouetteSample:
        rows = sample_n(doubles(df, columns, keep=[key]), key, n, seed=seed)
        points = rows.toPandas().sort_values(key).reset_index(drop=True)
        spark = df.sparkSession
        return cls(spark.createDataFrame(points, rows.schema), tuple(columns), points)

    def matrix(self) -> np.ndarray:
        return matrix(self.points, self.columns)

    def score(self, labelled: DataFrame, key: str, cluster: str) -> float | None:
        """Mean silhouette of the sampled rows; None with fewer than two clusters."""
        labels = dict(labelled.select(key, cluster).where(quote(cluster).isNotNull()).collect())
        return self.scores({0: self.points[key].map(labels).to_numpy()})[0]

    def scores(self, labellings: dict) -> dict:
        """Mean silhouette per labelling (one label per sampled row), in one job.

        Each task scores a slice of the bounded sample against the whole sample;
        distances are computed once for all labellings.
        """
        coded = {}
        for name, labels in labellings.items():
            names, code = np.unique(labels, return_inverse=True)
            if len(names) >= 2:
                coded[name] = code.astype("int64")
        if not coded:
            return dict.fromkeys(labellings)
        spark = self.rows.sparkSession
        shared = spark.sparkContext.broadcast((self.matrix(), list(coded.values())))

        def widths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            points, codes = shared.value
            for batch in batches:
                i = batch["id"].to_numpy()
                d = _distances(points[i], points)
                yield pd.DataFrame({f"s{n}": _widths(d, i, own) for n, own in enumerate(codes)})

        n = len(self.points)
        slices = max(1, min(spark.sparkContext.defaultParallelism, n // 250))
        names = [f"s{m}" for m in range(len(coded))]
        means = (
            spark.range(0, n, 1, slices)
            .mapInPandas(widths, ", ".join(f"{c} double" for c in names))
            .agg(*[F.avg(c) for c in names])
            .first()
        )
        shared.destroy()
        return {**dict.fromkeys(labellings), **{k: value_or_null(v) for k, v in zip(coded, means)}}


def _widths(d: np.ndarray, i: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Silhouette widths of rows ``i`` from their distances to the whole sample."""
    sizes = np.bincount(own)
    member = np.zeros((len(own), len(sizes)))
    member[np.arange(len(own)), own] = 1.0
    sums = d @ member
    mine, row = own[i], np.arange(len(i))
    a = sums[row, mine] / np.maximum(sizes[mine] - 1, 1)
    means = sums / sizes
    means[row, mine] = np.inf
    b = means.min(axis=1)
    top = np.maximum(a, b)
    return np.where((sizes[mine] > 1) & (top > 0), (b - a) / np.where(top > 0, top, 1.0), 0.0)


def _distances(a: np.ndarray, b: np.ndarray, block: int = 256) -> np.ndarray:
    """Euclidean distances in row blocks, by differences (exact for equal rows)."""
    out = np.empty((len(a), len(b)))
    for s in range(0, len(a), block):
        part = a[s : s + block]
        total = np.zeros((len(part), len(b)))
        for j in range(a.shape[1]):
            d = part[:, j : j + 1] - b[:, j]
            total += d * d
        out[s : s + block] = np.sqrt(total)
    return out


def silhouette(
    df: DataFrame, key: str, columns: Sequence[str], cluster: str, *, sample: int = 2_000, seed: int = 42
) -> float | None:
    """Mean Euclidean silhouette over min(sample, rows) sampled rows."""
    labelled = df.where(quote(cluster).isNotNull())
    drawn = sample_n(doubles(labelled, columns, keep=[key, cluster]), key, sample, seed=seed)
    drawn = drawn.persist()
    try:
        return SilhouetteSample.draw(drawn, key, columns, sample, seed).score(drawn, key, cluster)
    finally:
        drawn.unpersist()


def silhouette_squared(df: DataFrame, columns: Sequence[str], cluster: str) -> float:
    """Squared-Euclidean silhouette over all rows (linear time, no pairs)."""
    vectors = as_vectors(df, columns, keep=[cluster])
    return ClusteringEvaluator(featuresCol="features", predictionCol=cluster).evaluate(vectors)


def davies_bouldin(df: DataFrame, columns: Sequence[str], cluster: str) -> float | None:
    """Mean over clusters of the worst (Sᵢ+Sⱼ)/Mᵢⱼ, over all rows.

    Two partial aggregates by cluster; only k centres and k spreads are collected.
    """
    labelled = df.where(quote(cluster).isNotNull())
    found = cluster_centres(labelled, columns, cluster)
    if len(found) < 2:
        return None
    kind = df.schema[cluster].dataType.simpleString()
    centre_ddl = ", ".join(f"m{i}_ double" for i in range(len(columns)))
    centres = local_table(df.sparkSession, [(c, *m) for c, _, *m in found], f"cluster_ {kind}, {centre_ddl}")
    gap = " + ".join(f"({ident(c)} - m{i}_) * ({ident(c)} - m{i}_)" for i, c in enumerate(columns))
    spreads = dict(
        labelled.withColumnRenamed(cluster, "cluster_")
        .join(F.broadcast(centres), "cluster_")
        .groupBy("cluster_")
        .agg(F.expr(f"avg(sqrt({gap}))"))
        .collect()
    )
    s = np.array([spreads[c] for c, *_ in found])
    m = np.array([row[2:] for row in found], dtype="float64")
    between = _distances(m, m)
    if np.allclose(s, 0) or np.allclose(between, 0):
        return 0.0
    between[between == 0] = np.inf
    return float(((s[:, None] + s[None, :]) / between).max(axis=1).mean())


def cluster_summary(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    cluster: str,
    *,
    noise: int | None = None,
    sample: int = 2_000,
    seed: int = 42,
) -> dict[str, float | int | None]:
    """N_Clusters, Silhouette and Davies_Bouldin (4 decimals); N_Noise with ``noise``.

    Scores are None with fewer than two clusters; with a noise label they cover
    the other rows and need more of those than clusters.
    """
    is_noise = F.col("label_").eqNullSafe(F.lit(noise)) if noise is not None else F.lit(False)
    sizes = df.groupBy(quote(cluster).alias("label_")).agg(F.count("*").alias("n_"))
    n_clusters, n_rows, n_noise = sizes.agg(
        F.count_if(~is_noise), F.sum(F.when(~is_noise, F.col("n_"))), F.sum(F.when(is_noise, F.col("n_")))
    ).first()
    n_rows, n_noise = n_rows or 0, n_noise or 0
    report: dict = {"N_Clusters": n_clusters}
    if noise is not None:
        report["N_Noise"] = n_noise
    rows = df.where(quote(cluster) != F.lit(noise)) if noise is not None else df
    scored = n_clusters >= 2 and (noise is None or n_rows > n_clusters)
    sil = silhouette(rows, key, columns, cluster, sample=sample, seed=seed) if scored else None
    db = davies_bouldin(rows, columns, cluster) if scored else None
    report["Silhouette"] = None if sil is None else round(sil, 4)
    report["Davies_Bouldin"] = None if db is None else round(db, 4)
    return report
