"""Principal components of scaled numeric columns."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.sql import DataFrame

from surveyloom.functions import dot, local_table, quote
from surveyloom.operators.cluster.assign import as_vectors
from surveyloom.operators.features import standard_scale, varying_columns
from surveyloom.operators.sampling import sample_n


def fit_components(scaled: DataFrame, columns: Sequence[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Loadings (columns × k) and explained-variance ratios.

    The sign of a component is arbitrary: its largest loading is made positive.
    """
    model = PCA(k=k, inputCol="features", outputCol="scores").fit(as_vectors(scaled, columns))
    loadings = model.pc.toArray()
    top = np.abs(loadings).argmax(axis=0)
    return loadings * np.sign(loadings[top, np.arange(k)]), model.explainedVariance.toArray()


def pca_project(
    df: DataFrame, key: str, columns: Sequence[str], k: int, *, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(key, keep…, pc1…pck) for every row, and the explained variance in percent.

    Columns are standardised first (so centred) and constant ones left out; the
    scores are inner products with the loadings, without a shuffle.
    """
    varying = varying_columns(df, columns)
    if len(varying) < k:
        raise ValueError(f"{k} components need at least {k} varying columns")
    scaled = standard_scale(df, varying)
    loadings, ratio = fit_components(scaled, varying, k)
    # Kept columns come from the unscaled table, so scaling must not rename them.
    kept = {c: f"keep_{i}_" for i, c in enumerate(keep)}
    source = df.select(quote(key), *[quote(c).alias(n) for c, n in kept.items()], *[quote(c) for c in varying])
    scores = standard_scale(source, varying, fit_on=df).selectExpr(
        f"`{key}`",
        *[f"{n} as `{c}`" for c, n in kept.items()],
        *[f"{dot(varying, loadings[:, j])} as pc{j + 1}" for j in range(k)],
    )
    explained = local_table(
        df.sparkSession, [(j + 1, float(r) * 100.0) for j, r in enumerate(ratio)], "component int, percent double"
    )
    return scores, explained


def pca_plot_sample(
    df: DataFrame, key: str, columns: Sequence[str], target: str, *, rows: int = 50_000, seed: int = 42
) -> DataFrame:
    """Three scores and the target of at most ``rows`` sampled rows."""
    scores, _ = pca_project(df, key, columns, 3, keep=[target])
    return sample_n(scores, key, rows, seed=seed)
