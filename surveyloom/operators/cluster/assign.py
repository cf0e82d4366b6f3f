"""Shared pieces of the clusterings: vectors, layout, nearest centre."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import doubles, ident, quote, sq_dist

# Above this many (centre, column) terms one generated method grows too big for
# the JIT, and vectorised batches are faster.
MAX_SQL_TERMS = 200
MAX_CLUSTERS = 10_000
ROWS_PER_TASK = 16_000
#: Rows of a block, and of the slices a pass works on.
BLOCK_ROWS, SLICE_ROWS = 16_384, 4_096


def spread(df: DataFrame, *, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """A layout for repeated passes, for tables too small to fill the cores.

    One small file arrives as one partition, which idles cores on 10⁵ rows; and a
    few thousand rows on every core cost more in task starts than in work.  A
    table with enough rows for every core keeps its own partitions.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    rows = df.count()
    wanted = -(-rows // rows_per_task)
    parts = df.rdd.getNumPartitions()
    if wanted < cores:
        return df.coalesce(max(wanted, 1)) if wanted <= parts else df.repartition(wanted)
    return df.repartition(cores) if parts < cores else df


def blocks(df: DataFrame, columns: Sequence[str], *, rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows without null or NaN as ``block``, for repeated passes: so many rows of doubles, feature by feature."""
    names = list(columns)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for batch in batches:
            x = matrix(batch, names)
            held.append(x[~np.isnan(x).any(axis=1)])
            n += len(held[-1])
            if n >= rows:
                yield pd.DataFrame({"block": [np.concatenate(held).T.tobytes()]})
                held, n = [], 0
        if n:
            yield pd.DataFrame({"block": [np.concatenate(held).T.tobytes()]})

    return doubles(df, names).mapInPandas(pack, "block binary")


def block_slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    """The rows of ``blocks`` (features × rows), as many at a time as a core's cache holds."""
    for batch in batches:
        for raw in batch.column(0):
            x = np.frombuffer(raw.as_buffer(), np.float64).reshape(width, -1)
            for at in range(0, x.shape[1], SLICE_ROWS):
                yield np.ascontiguousarray(x[:, at : at + SLICE_ROWS])


def as_vectors(df: DataFrame, columns: Sequence[str], *, keep: Sequence[str] = (), out: str = "features") -> DataFrame:
    assembler = VectorAssembler(inputCols=list(columns), outputCol=out)
    return assembler.transform(df).select(*[quote(c) for c in keep], out)


def matrix(pdf: pd.DataFrame, columns: Sequence[str]) -> np.ndarray:
    return pdf[list(columns)].to_numpy(dtype="float64")


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances (rows × centres), one centre at a time."""
    return np.stack([((x - c) ** 2).sum(axis=1) for c in centres], axis=1)


_FIRST_NEAREST = (
    "case when not isnan(array_min(distances_)) "
    "then cast(array_position(distances_, array_min(distances_)) - 1 as int) end"
)


def nearest_centroid(
    df: DataFrame, columns: Sequence[str], centres: Sequence[Sequence[float]], *, out: str = "cluster"
) -> DataFrame:
    """Index of the Euclidean-nearest centre, lowest index on a tie; no shuffle.

    A row with a null or NaN feature has no nearest centre: its cluster is null.
    """
    if len(centres) * len(columns) <= MAX_SQL_TERMS:
        each = ", ".join(sq_dist(columns, c) for c in centres)
        return (
            df.withColumn("distances_", F.expr(f"array({each})"))
            .withColumn(out, F.expr(_FIRST_NEAREST))
            .drop("distances_")
        )
    points = np.asarray(centres, dtype="float64")

    @F.pandas_udf("int")
    def closest(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for series in batches:
            x = np.column_stack([s.to_numpy(dtype="float64") for s in series])
            near = pd.array(distances(x, points).argmin(axis=1), dtype="Int32")
            near[np.isnan(x).any(axis=1)] = pd.NA
            yield pd.Series(near)

    return df.withColumn(out, closest(*[F.expr(f"cast({ident(c)} as double)") for c in columns]))


def cluster_centres(df: DataFrame, columns: Sequence[str], cluster: str) -> list[tuple]:
    """(cluster, size, mean per column), in cluster order; one partial aggregate."""
    rows = (
        df.groupBy(quote(cluster).alias("cluster_"))
        .agg(F.count("*").alias("n_"), *[F.expr(f"avg({ident(c)})") for c in columns])
        .limit(MAX_CLUSTERS + 1)
        .collect()
    )
    if len(rows) > MAX_CLUSTERS:
        raise ValueError(f"{cluster} has more than {MAX_CLUSTERS} clusters")
    return sorted(tuple(r) for r in rows)
