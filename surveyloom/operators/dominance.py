"""Dominance counts by divide and conquer: for every point, the weight of those at least as good in all metrics.

Points stand in the order of their first metric (ties by the next ones) and are
cut into blocks.  A point and a better one are either in the same block, where
they are compared directly, or in the two halves of exactly one node of the
binary tree over the blocks; there the first metric is settled and the question
has one metric less.  The last metric is a running sum of weights.  A table of n
points and d metrics sends about n · log(n / block)^(d − 1) rows through shuffles,
and no group is larger than a block or a range partition.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.functions import cut_lineage, ident, quote

#: A point asks, is counted as a rival, or both.
ASKS, RIVALS, BOTH = 0, 1, 2


def running_sum(df: DataFrame, group: Sequence[str], order: Sequence[str], value: Column, *, out: str, total: str) -> DataFrame:
    """Adds the sum of ``value`` up to each row in its group's order, and the group's total.

    The rows are range-partitioned by (group, order), so a group of any size is
    split; each piece is summed on its own and moved by the sum of the pieces
    before it. ``order`` should tell the rows of a group apart.
    """
    by, inside = [quote(c) for c in group], [quote(c) for c in order]
    # The pieces must be the same for the sums and for the rows, so they are written once.
    pieces = cut_lineage(
        df.withColumn(out, value).repartitionByRange(*by, *inside).withColumn("piece_", F.spark_partition_id())
    )
    before = Window.partitionBy(*by).orderBy("piece_").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        pieces.groupBy("piece_", *by).agg(F.sum(out).alias("sum_"))
        .withColumn("before_", F.coalesce(F.sum("sum_").over(before), F.lit(0)))
        .withColumn(total, F.sum("sum_").over(Window.partitionBy(*by)))
        .drop("sum_")
    )
    within = Window.partitionBy("piece_", *by).orderBy(*inside).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        pieces.withColumn(out, F.sum(out).over(within))
        .join(sums, ["piece_", *group])
        .withColumn(out, F.col(out) + F.col("before_"))
        .drop("piece_", "before_")
    )


def dominators(points: DataFrame, names: Sequence[str], *, weight: str, block: int, out: str) -> DataFrame:
    """(names…, out): the weight of the points that are >= in every named column, each point itself included.

    ``points`` holds distinct rows of doubles without null or NaN.
    """
    if block < 1:
        raise ValueError("block must be at least 1")
    to = [f"p{i}_" for i in range(len(names))]
    asked = points.selectExpr(
        *[f"{ident(c)} as {t}" for c, t in zip(names, to)], f"cast({ident(weight)} as long) as n_", f"{BOTH} as role_"
    )
    parts = _count(asked, to, to, [], block, asked.count())
    summed = parts.groupBy(*to).agg(F.sum("part_").alias(out))
    return summed.selectExpr(*[f"{t} as {ident(c)}" for c, t in zip(names, to)], ident(out))


def _count(rows: DataFrame, point: list[str], open_: list[str], group: list[str], block: int, most: int) -> DataFrame:
    """(point…, part_) of the rows that ask, against the rivals of their group in the ``open_`` metrics.

    ``most`` bounds the rows of a group.
    """
    if not group and most <= block:
        return _compared(rows.withColumn("block_", F.lit(0)), point, open_, ["block_"])
    if len(open_) == 1:
        return _settled(rows, point, open_[0], group)

    # Rivals follow the rows they equal, so whoever stands later is at least as good in the first open metric.
    order = [*open_, "role_", *[p for p in point if p not in open_]]
    placed = cut_lineage(
        running_sum(rows, group, order, F.lit(1).cast("long"), out="place_", total="total_")
        .withColumn("block_", F.floor((F.col("place_") - 1) / block).cast("long"))
        .drop("place_")
    )
    near = _compared(placed, point, open_, [*group, "block_"])
    levels = (-(-most // block) - 1).bit_length()
    if levels == 0:
        return near

    level, node = f"level{len(open_)}_", f"node{len(open_)}_"
    halves = (
        placed.withColumn(level, F.explode(F.sequence(F.lit(1), F.lit(levels))))
        .withColumn("half_", F.expr(f"block_ div cast(pow(2, {level} - 1) as long)"))
        .withColumn(node, F.expr("half_ div 2"))
        .withColumn("side_", F.expr("cast(half_ % 2 as int)"))
        # The lower half asks the upper one, if there is one.
        .where(
            f"(side_ = {RIVALS} and role_ != {ASKS}) or (side_ = {ASKS} and role_ != {RIVALS} "
            f"and (half_ + 1) * cast(pow(2, {level} - 1) as long) * {block} < total_)"
        )
        .withColumn("role_", F.col("side_"))
        .select(*point, "n_", "role_", *group, level, node)
    )
    return near.unionByName(_count(halves, point, open_[1:], [*group, level, node], block, most))


def _settled(rows: DataFrame, point: list[str], last: str, group: list[str]) -> DataFrame:
    """One open metric: the rivals' weight up to each asking row, from the best value down."""
    down = rows.withColumn("down_", -F.col(last)).withColumn("asks_", (F.col("role_") == ASKS).cast("int"))
    weight = F.when(F.col("role_") == ASKS, F.lit(0).cast("long")).otherwise(F.col("n_"))
    summed = running_sum(down, group, ["down_", "asks_", *point], weight, out="part_", total="total_")
    return summed.where(f"role_ != {RIVALS} and part_ > 0").select(*point, "part_")


def _compared(rows: DataFrame, point: list[str], open_: list[str], group: list[str]) -> DataFrame:
    """Blocks of bounded size, every asking row compared with every rival."""

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        ask, rival = pdf[pdf["role_"] != RIVALS], pdf[pdf["role_"] != ASKS]
        x, y = ask[open_].to_numpy(dtype="float64"), rival[open_].to_numpy(dtype="float64")
        better = np.ones((len(x), len(y)), dtype=bool)
        for j in range(len(open_)):
            better &= y[None, :, j] >= x[:, None, j]
        return ask[point].assign(part_=(better @ rival["n_"].to_numpy()).astype("int64"))

    schema = ", ".join(f"{p} double" for p in point) + ", part_ long"
    return rows.select(*point, "n_", "role_", *group).groupBy(*group).applyInPandas(count, schema)
