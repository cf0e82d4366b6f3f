"""Tables behind the figures that are not reports of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from surveyloom.functions import doubles, ident
from surveyloom.operators.profile import pearson_vs_target
from surveyloom.operators.sampling import sample_n


def scatter_sample(
    df: DataFrame, key: str, columns: Sequence[str], target: str, *, rows: int = 50_000, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(column, key, x, y) of a capped sample, and r per column on that sample."""
    drawn = sample_n(df.selectExpr(ident(key), ident(target), *[ident(c) for c in columns]), key, rows, seed=seed)
    points = (
        doubles(drawn, columns, keep=[key, target])
        .unpivot([key, target], list(columns), "column", "x")
        .withColumnRenamed(target, "y")
    )
    return points, pearson_vs_target(drawn, columns, target)


def series(sweep: DataFrame, value: str) -> DataFrame:
    """(k, value): one curve of the K-Means sweep."""
    return sweep.selectExpr("k", f"{ident(value)} as value")
