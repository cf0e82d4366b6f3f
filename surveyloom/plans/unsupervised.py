"""The clustering step: scale, embed, five clusterings, relabel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.config import SurveyConfig
from surveyloom.functions import cut_lineage, ident, numeric_columns
from surveyloom.operators import cluster, features, reduce


def cluster_all(df: DataFrame, config: SurveyConfig = SurveyConfig()) -> tuple[DataFrame, dict[str, dict], DataFrame]:
    """(key + one cluster column per method, summaries, the sweep over k)."""
    key = config.key
    columns = numeric_columns(df, [key, config.target, config.category])
    scaled = cluster.spread(
        cut_lineage(features.standard_scale(df.selectExpr(ident(key), *[ident(c) for c in columns]), columns))
    )
    sweep, fits = cluster.kmeans_sweep(
        scaled, key, columns, k_min=config.k_min, k_max=config.k_max, restarts=config.kmeans_restarts,
        seed=config.seed, silhouette_rows=config.silhouette_rows,
    )
    k = cluster.elbow_k(sweep).first()["k"]
    eps = cluster.dbscan_eps(scaled, key, columns, floor=config.min_eps, sample=config.eps_rows, seed=config.seed)
    found = {
        "KMeans": cluster.kmeans_fit(scaled, key, columns, fits[k]),
        "FuzzyCMeans": cluster.fuzzy_cmeans(scaled, key, columns, k, seed=config.seed)[0],
        "DBSCAN": cluster.dbscan(scaled, key, columns, eps, min_points=config.min_points, seed=config.seed),
        "Subtractive": cluster.subtractive_cluster(scaled, key, columns, sample=config.subtractive_rows, seed=config.seed)[0],
        "Agglomerative": cluster.agglomerative(scaled, key, columns, k, micro=config.micro_clusters, seed=config.seed),
    }
    labels = scaled
    for name, table in found.items():
        labels = labels.join(table.withColumnRenamed("cluster", name), key)
    labels = cut_lineage(labels)
    summaries = {
        name: cluster.cluster_summary(
            labels, key, columns, name, noise=-1 if name == "DBSCAN" else None,
            sample=config.silhouette_rows, seed=config.seed,
        )
        for name in found
    }
    return labels.selectExpr(ident(key), *[ident(name) for name in found]), summaries, sweep


def run_unsupervised(df: DataFrame, config: SurveyConfig = SurveyConfig()) -> tuple[DataFrame, dict[str, dict]]:
    """The table with its ``cluster_label``, and one summary per clustering."""
    labels, summaries, _ = cluster_all(df, config)
    return label_by_kmeans(df, labels, config), summaries


def label_by_kmeans(df: DataFrame, labels: DataFrame, config: SurveyConfig = SurveyConfig()) -> DataFrame:
    """Join the K-Means ids back and turn them into ordered labels."""
    ids = labels.selectExpr(ident(config.key), "KMeans as cluster_id_")
    joined = df.join(ids, config.key)
    return cluster.relabel_by_rank(
        joined, "cluster_id_", config.target, ordered=config.ordered_labels, out=config.label
    ).drop("cluster_id_")


def cluster_scatter(df: DataFrame, labels: DataFrame, config: SurveyConfig = SurveyConfig(), *, method: str = "KMeans") -> DataFrame:
    """(key, pc1, pc2, label) of every row; −1 is named Noise."""
    columns = numeric_columns(df, [config.key, config.target, config.category])
    scores, _ = reduce.pca_project(df, config.key, columns, 2)
    named = labels.select(
        config.key,
        F.expr(f"if({ident(method)} = -1, 'Noise', concat('Cluster ', cast({ident(method)} as string))) as label"),
    )
    return scores.join(named, config.key)
