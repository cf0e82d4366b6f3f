"""Cluster ids to ordered labels, by the rank of a target's median."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.config import SEVERITY_LABELS
from surveyloom.functions import local_table
from surveyloom.operators.ranks import exact_percentiles


def spaced_labels(k: int, ordered: Sequence[str] = SEVERITY_LABELS) -> list[str]:
    """k labels evenly spaced over the ordered list, ends included."""
    if k > len(ordered):
        raise ValueError(f"{k} clusters but only {len(ordered)} ordered labels")
    if k == 1:
        return [ordered[0]]
    return [ordered[round(i)] for i in np.linspace(0, len(ordered) - 1, k)]


def rank_labels(df: DataFrame, cluster: str, target: str, *, ordered: Sequence[str] = SEVERITY_LABELS) -> DataFrame:
    """(cluster, median, label): lowest median gets the first label, ties by id."""
    medians = exact_percentiles(df, [target], [0.5], by=cluster)
    ranked = sorted(((v[0], c) for (c, _), v in medians.items()))
    rows = [(c, m, label) for (m, c), label in zip(ranked, spaced_labels(len(ranked), ordered))]
    kind = df.schema[cluster].dataType.simpleString()
    return local_table(df.sparkSession, rows, f"`{cluster}` {kind}, median double, label string")


def relabel_by_rank(
    df: DataFrame, cluster: str, target: str, *, ordered: Sequence[str] = SEVERITY_LABELS, out: str = "cluster_label"
) -> DataFrame:
    """Every row with its cluster's label; the map is k rows and broadcast."""
    labels = rank_labels(df, cluster, target, ordered=ordered).select(cluster, F.col("label").alias(out))
    return df.join(F.broadcast(labels), cluster, "left")
