from surveyloom.operators.cluster.assign import as_vectors, nearest_centroid, spread
from surveyloom.operators.cluster.density import dbscan, dbscan_eps
from surveyloom.operators.cluster.fuzzy import fcm_membership_step, fuzzy_cmeans
from surveyloom.operators.cluster.hierarchical import agglomerative
from surveyloom.operators.cluster.partition import elbow_k, kmeans_fit, kmeans_sweep, within_sums
from surveyloom.operators.cluster.quality import (
    cluster_summary, davies_bouldin, silhouette, silhouette_squared,
)
from surveyloom.operators.cluster.relabel import rank_labels, relabel_by_rank
from surveyloom.operators.cluster.subtractive import subtractive_centres, subtractive_cluster, subtractive_potential

__all__ = [
    "agglomerative", "as_vectors", "cluster_summary", "davies_bouldin", "dbscan", "dbscan_eps",
    "elbow_k", "fcm_membership_step", "fuzzy_cmeans", "kmeans_fit", "kmeans_sweep", "nearest_centroid",
    "rank_labels", "relabel_by_rank", "silhouette", "silhouette_squared", "spread", "subtractive_centres",
    "subtractive_cluster", "subtractive_potential", "within_sums",
]
