"""Exact order statistics and quantiles without sorting a table.

Values are pre-aggregated to (group, value, count), so copies never travel.  A
group with few distinct values is ranked directly.  For any other group the
wanted ranks are bracketed with ``percentile_approx`` sketches and only the
distinct values inside a bracket are ranked; a bracket that still holds too many
is narrowed again.  So no task ranks more than ``limit`` values, however skewed
or wide the column is, and the result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.functions import local_table, unpivot

DISTINCT_LIMIT = 200_000
SKETCH_ACCURACY = 10_000
MAX_GROUPS = 10_000


def group_sizes(values: DataFrame, by: Sequence[str]) -> dict[tuple, tuple[int, int]]:
    """{group: (rows, approximate distinct values)}; groups must be few."""
    rows = (
        values.groupBy(*by)
        .agg(F.count("*").alias("n"), F.approx_count_distinct("value").alias("d"))
        .limit(MAX_GROUPS + 1)
        .collect()
    )
    if len(rows) > MAX_GROUPS:
        raise ValueError(f"too many groups in {list(by)} for per-group ranks")
    return {tuple(r[b] for b in by): (r["n"], r["d"]) for r in rows}


def rank_select(
    values: DataFrame,
    wanted: dict[tuple, list[int]],
    *,
    by: Sequence[str],
    sizes: dict[tuple, tuple[int, int]],
    limit: int = DISTINCT_LIMIT,
    accuracy: int = SKETCH_ACCURACY,
) -> dict[tuple, dict[int, float]]:
    """Values at zero-based ranks: {group: {rank: value}}.

    ``values`` has the columns ``by`` and ``value``, all without nulls.
    """
    by = list(by)
    found: dict[tuple, dict[int, float]] = {g: {} for g in wanted}
    # (group, rank) → (low, high, rows below low)
    whole = (None, None, 0)
    few = {(g, r): whole for g, ranks in wanted.items() for r in ranks if sizes[g][1] <= limit}
    many = {(g, r): whole for g, ranks in wanted.items() for r in ranks if sizes[g][1] > limit}
    if few:
        for g, r, v in _rank_values(values, few, by):
            found[g][r] = v
    spans = {k: (sizes[k[0]][0], sizes[k[0]][1]) for k in many}
    while many:
        narrowed = _narrow(values, many, spans, by, accuracy)
        ready = {}
        many = {}
        for key, (bracket, n, distinct) in narrowed.items():
            stalled = n >= spans.get(key, (n + 1,))[0]
            if distinct <= limit or stalled:
                ready[key] = bracket
            else:
                many[key] = bracket
            spans[key] = (n, distinct)
        if ready:
            for g, r, v in _rank_brackets(values, ready, by):
                found[g][r] = v
    return found


def _bracket_table(values: DataFrame, brackets: dict, by: list[str]) -> DataFrame:
    keys = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in values.select(*by).schema)
    rows = [(*g, r, *b) for (g, r), b in brackets.items()]
    return local_table(
        values.sparkSession, rows, f"{keys}, rank_ long, low_ double, high_ double, below_ long"
    )


_IN_BRACKET = "(low_ is null or value >= low_) and (high_ is null or value <= high_)"


def _hits(counted: DataFrame, by: list[str]):
    """Pick, for each rank, the value whose run of copies covers it."""
    covers = "upto_ > rank_ and upto_ - n_ <= rank_"
    return [
        (tuple(r[b] for b in by), r["rank_"], r["value"])
        for r in counted.where(covers).select(*by, "rank_", "value").collect()
    ]


def _running(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("value").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )


def _rank_values(values: DataFrame, wanted: dict, by: list[str]):
    """Whole groups with few distinct values: count each value once, then rank."""
    table = _bracket_table(values, wanted, by)
    groups = F.broadcast(table.select(*by).distinct())
    counted = (
        values.join(groups, by, "left_semi")
        .groupBy(*by, "value")
        .agg(F.count("*").alias("n_"))
        .withColumn("upto_", F.sum("n_").over(_running(by)))
        .join(F.broadcast(table), by)
    )
    return _hits(counted, by)


def _rank_brackets(values: DataFrame, brackets: dict, by: list[str]):
    """Values inside narrow brackets: count each once, then rank from ``below_``."""
    keys = [*by, "rank_"]
    counted = (
        values.join(F.broadcast(_bracket_table(values, brackets, by)), by)
        .where(_IN_BRACKET)
        .groupBy(*keys, "below_", "value")
        .agg(F.count("*").alias("n_"))
        .withColumn("upto_", F.col("below_") + F.sum("n_").over(_running(keys)))
    )
    return _hits(counted, by)


def _narrow(values: DataFrame, brackets: dict, spans: dict, by: list[str], accuracy: int):
    """Shrink each bracket around its rank: {key: (bracket, rows, distinct)}."""
    keys = [*by, "rank_"]
    slack = 3.0 / accuracy
    probes = {}
    for key, (_, _, below) in brackets.items():
        p = (key[1] - below) / max(spans[key][0] - 1, 1)
        probes[key] = (max(0.0, p - slack), min(1.0, p + slack))
    points = sorted({p for pair in probes.values() for p in pair})
    inside = values.join(F.broadcast(_bracket_table(values, brackets, by)), by).where(_IN_BRACKET)
    sketches = inside.groupBy(*keys).agg(
        F.percentile_approx("value", [float(p) for p in points], accuracy).alias("q")
    )
    proposed = {}
    for r in sketches.collect():
        key = (tuple(r[b] for b in by), r["rank_"])
        q = dict(zip(points, r["q"]))
        p_low, p_high = probes[key]
        old_low, old_high, _ = brackets[key]
        proposed[key] = (
            old_low if p_low == 0.0 else q[p_low],
            old_high if p_high == 1.0 else q[p_high],
        )
    return _verify(values, proposed, brackets, by)


def _verify(values: DataFrame, proposed: dict, previous: dict, by: list[str]):
    """Count around each proposed bracket; where it misses its rank, take the side that has it."""
    keys = [*by, "rank_"]
    for key in previous:
        proposed.setdefault(key, previous[key][:2])
    candidates = {k: (low, high, 0) for k, (low, high) in proposed.items()}
    result, missed = {}, {}
    counts = (
        values.join(F.broadcast(_bracket_table(values, candidates, by)), by)
        .groupBy(*keys)
        .agg(
            F.expr("count(case when value < low_ then 1 end)").alias("under"),
            F.expr(f"count(case when {_IN_BRACKET} then 1 end)").alias("inside"),
            F.expr(f"approx_count_distinct(case when {_IN_BRACKET} then value end)").alias("d"),
        )
        .collect()
    )
    for r in counts:
        key = (tuple(r[b] for b in by), r["rank_"])
        low, high = proposed[key]
        if key[1] < r["under"]:
            missed[key] = (previous[key][0], low)
        elif key[1] >= r["under"] + r["inside"]:
            missed[key] = (high, previous[key][1])
        else:
            result[key] = ((low, high, r["under"]), r["inside"], r["d"])
    if missed:
        result.update(_verify(values, missed, {k: previous[k] for k in missed}, by))
    return result


def exact_percentiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    *,
    by: str | None = None,
    limit: int = DISTINCT_LIMIT,
) -> dict[tuple, list[float]]:
    """Linearly interpolated quantiles {(by?, column): [value per probability]}.

    ``by`` must be a low-cardinality column (clusters, classes, splits); its null
    group is left out.  Columns without any value are absent from the result.
    """
    names = [by, "column"] if by else ["column"]
    long = unpivot(df, columns, [by] if by else []).where("value is not null")
    if by:
        long = long.where(F.col(by).isNotNull())
    sizes = group_sizes(long, names)
    wanted = {}
    for g, (n, _) in sizes.items():
        positions = [p * (n - 1) for p in probabilities]
        wanted[g] = sorted({r for x in positions for r in (math.floor(x), math.ceil(x))})
    at = rank_select(long, wanted, by=names, sizes=sizes, limit=limit)
    result = {}
    for g, (n, _) in sizes.items():
        result[g] = []
        for p in probabilities:
            x = p * (n - 1)
            low, high = at[g][math.floor(x)], at[g][math.ceil(x)]
            result[g].append(low + (high - low) * (x - math.floor(x)))
    return result
