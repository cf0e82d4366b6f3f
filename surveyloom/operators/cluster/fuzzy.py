"""Fuzzy C-Means over all rows: memberships per batch, weighted sums per centre."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import complete, cut_lineage, doubles, ident
from surveyloom.operators.cluster.assign import block_slices, blocks, distances, matrix, nearest_centroid, spread
from surveyloom.operators.cluster.partition import START_POINTS, lloyd, spread_start, starting_points


def _shares(d: np.ndarray, fuzzifier: float) -> np.ndarray:
    """Memberships from squared distances (centres × rows)."""
    on = d == 0
    with np.errstate(divide="ignore"):
        w = 1.0 / np.where(on, np.inf, d) if fuzzifier == 2 else np.where(on, np.inf, d) ** (-1.0 / (fuzzifier - 1.0))
    hit = on.any(axis=0)
    w[:, hit] = on[:, hit]
    return w / w.sum(axis=0)


def memberships(x: np.ndarray, centres: np.ndarray, fuzzifier: float) -> np.ndarray:
    """Row memberships; a row lying on centres belongs to those alone."""
    return _shares(distances(x, centres).T, fuzzifier).T


def _weighted_sums(data: DataFrame, columns: Sequence[str], centres: np.ndarray, fuzzifier: float):
    """Per centre Σuᵐ and Σuᵐx over ``blocks``: one small row set per partition, then one sum."""
    wide = len(columns)
    sums = [f"s{i}" for i in range(wide)]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centres), wide + 1))
        for x in block_slices(batches, wide):
            u = _shares(np.stack([((x - c[:, None]) ** 2).sum(axis=0) for c in centres]), fuzzifier)
            u = u * u if fuzzifier == 2 else u**fuzzifier
            total += u @ np.vstack([np.ones(x.shape[1]), x]).T
        columns = [pa.array(np.arange(len(centres), dtype=np.int32)), *(pa.array(v) for v in total.T)]
        yield pa.record_batch(columns, ["cluster", "weight", *sums])

    schema = "cluster int, weight double, " + ", ".join(f"{s} double" for s in sums)
    return data.mapInArrow(partial, schema).groupBy("cluster").agg(F.sum("weight").alias("weight"), *[F.expr(f"sum({s}) as {s}") for s in sums])


def fcm_membership_step(
    df: DataFrame, columns: Sequence[str], centres: Sequence[Sequence[float]], *, fuzzifier: float = 2.0
) -> DataFrame:
    """One update of the centres: (cluster, weight, one column per feature)."""
    sums = _weighted_sums(blocks(df, columns), columns, np.asarray(centres, dtype="float64"), fuzzifier)
    return sums.selectExpr("cluster", "weight", *[f"s{i} / weight as {ident(c)}" for i, c in enumerate(columns)])


def membership_columns(
    df: DataFrame, key: str, columns: Sequence[str], centres: Sequence[Sequence[float]], *, fuzzifier: float = 2.0
) -> DataFrame:
    """(key, u0 … u(c−1)): the memberships of every row."""
    points = np.asarray(centres, dtype="float64")
    names = list(columns)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            u = memberships(matrix(batch, names), points, fuzzifier)
            out = pd.DataFrame(u, columns=[f"u{j}" for j in range(len(points))])
            out.insert(0, key, batch[key].to_numpy())
            yield out

    schema = f"`{key}` {df.schema[key].dataType.simpleString()}, " + ", ".join(f"u{j} double" for j in range(len(points)))
    return doubles(df, names, keep=[key]).mapInPandas(rows, schema)


def fcm_centres(
    df: DataFrame,
    columns: Sequence[str],
    c: int,
    *,
    fuzzifier: float = 2.0,
    error: float = 0.005,
    max_iter: int = 1_000,
    seed: int = 42,
) -> np.ndarray:
    """Centres at convergence: largest centre shift below ``error``.

    Rows with a null or NaN feature take no part.
    """
    rows = spread(cut_lineage(complete(doubles(df, columns), columns)))
    start = spread_start(starting_points(rows, columns, START_POINTS, seed), c, seed)
    data = blocks(rows, columns).persist()
    centres = lloyd(data, columns, [start], max_iter=1)[0].means
    for _ in range(max_iter):
        moved = _weighted_sums(data, columns, centres, fuzzifier).orderBy("cluster").collect()
        updated = np.array([row[2:] for row in moved], dtype="float64") / np.array([row[1] for row in moved])[:, None]
        shift = np.sqrt(((updated - centres) ** 2).sum(axis=1)).max()
        centres = updated
        if shift < error:
            break
    data.unpersist()
    return centres


def fuzzy_cmeans(df: DataFrame, key: str, columns: Sequence[str], c: int, **options) -> tuple[DataFrame, np.ndarray]:
    """(key, cluster) by highest membership, and the centres."""
    centres = fcm_centres(df, columns, c, **options)
    # Membership falls with distance, so the nearest centre has the highest.
    return nearest_centroid(df, columns, centres.tolist()).select(key, "cluster"), centres
