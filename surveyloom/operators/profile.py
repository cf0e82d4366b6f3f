"""Descriptive statistics: one fused aggregate per report, then a long table."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import (
    doubles, ident, literal, local_table, numeric_columns, quote, text_literal, unpivot, value_or_null,
)
from surveyloom.operators.ranks import exact_percentiles


def _per_column(df: DataFrame, columns: Sequence[str], measures: dict[str, str]) -> DataFrame:
    """One pass over the table: one struct of measures per column, then rows.

    A measure is SQL text with {c} for the column and {t} for its name as text.
    """
    structs = [
        "struct("
        + ", ".join(
            [f"{text_literal(c)} as column"]
            + [f"{sql.format(c=ident(c), t=text_literal(c))} as {name}" for name, sql in measures.items()]
        )
        + ")"
        for c in columns
    ]
    return df.selectExpr(f"array({', '.join(structs)}) as rows").selectExpr("inline(rows)")


def dataset_overview(df: DataFrame) -> DataFrame:
    """Per column: kind and null count, beside the row and column counts."""
    numeric = ", ".join(text_literal(c) for c in numeric_columns(df)) or "''"
    return _per_column(
        df,
        df.columns,
        {
            "kind": f"if({{t}} in ({numeric}), 'numeric', 'categorical')",
            "nulls": "count(case when {c} is null then 1 end)",
            "n_rows": "count(*)",
            "n_columns": str(len(df.columns)),
        },
    )


def _quantile_rows(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> list[tuple]:
    q = exact_percentiles(df, columns, probs)
    return [(c, *q.get((c,), [None] * len(probs))) for c in columns]


def central_tendency(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean (3 decimals) and exact median per column."""
    medians = _quantile_rows(df, columns, [0.5])
    table = local_table(df.sparkSession, medians, "column string, median double")
    means = _per_column(df, columns, {"mean": "round(avg(cast({c} as double)), 3)"})
    return means.join(F.broadcast(table), "column")


def mode_all_ties(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every most frequent value of every column, as text; nulls ignored.

    The counts are shuffled once, pre-aggregated; the winning count per column
    comes back as a small broadcast, so no column is ranked in one task.
    """
    counts = (
        unpivot(df, columns, as_type="string")
        .where("value is not null")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    best = counts.groupBy("column").agg(F.max("n").alias("n"))
    return counts.join(F.broadcast(best), ["column", "n"]).select("column", "value", "n")


def dispersion(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Range, sample variance and sample deviation (4 decimals)."""
    return _per_column(
        df,
        columns,
        {
            "range": "cast(max({c}) - min({c}) as double)",
            "variance": "round(var_samp({c}), 4)",
            "std_dev": "round(stddev_samp({c}), 4)",
        },
    )


def fences(df: DataFrame, columns: Sequence[str], *, width: float = 1.5) -> list[tuple]:
    """(column, q1, q2, q3, low fence, high fence) with linear interpolation."""
    rows = []
    for c, q1, q2, q3 in _quantile_rows(df, columns, [0.25, 0.5, 0.75]):
        if q1 is None:
            rows.append((c, None, None, None, None, None))
        else:
            rows.append((c, q1, q2, q3, q1 - width * (q3 - q1), q3 + width * (q3 - q1)))
    return rows


def position_measures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, interquartile range and fences (3 decimals)."""
    table = local_table(
        df.sparkSession, fences(df, columns),
        "column string, q1 double, q2 double, q3 double, lower_fence double, upper_fence double",
    )
    return table.selectExpr(
        "column", "round(q1, 3) as q1", "round(q2, 3) as q2", "round(q3, 3) as q3", "round(q3 - q1, 3) as iqr",
        "round(lower_fence, 3) as lower_fence", "round(upper_fence, 3) as upper_fence",
    )


def outlier_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values strictly outside the fences, all columns in one pass."""
    outside = {
        c: "false" if low is None else f"{ident(c)} < {literal(low)} or {ident(c)} > {literal(high)}"
        for c, _, _, _, low, high in fences(df, columns)
    }
    structs = [f"struct({text_literal(c)} as column, count(case when {o} then 1 end) as outliers)" for c, o in outside.items()]
    return df.selectExpr(f"array({', '.join(structs)}) as rows").selectExpr("inline(rows)")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Frequency and percent of each value of the columns that exist."""
    present = [c for c in columns if c in df.columns]
    counts = (
        unpivot(df, present, as_type="string")
        .where("value is not null")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(totals), "column").select(
        "column", "value", "n", F.expr("n * 100.0D / total").alias("percent")
    )


def pearson_vs_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    return _per_column(df, columns, {"r": f"corr(cast({{c}} as double), cast({ident(target)} as double))"})


#: Rows whose means the correlation sums are taken about; any typical value will do.
SHIFT_ROWS = 100


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Strictly lower triangle of the Pearson matrix, long form.

    Each pair uses the rows where both columns hold a number; a constant or empty
    pair has a null r. Tasks send one row of sums per pair, taken about the means
    of the first rows so that large means lose no digits.
    """
    names = list(columns)
    rows = doubles(df, names)
    first = np.array([tuple(r) for r in rows.head(SHIFT_ROWS)], dtype="float64").reshape(-1, len(names))
    held = ~np.isnan(first)
    means = np.where(held, first, 0.0).sum(axis=0) / np.maximum(held.sum(axis=0), 1)
    i, j = np.tril_indices(len(names), -1)
    fields = ["n", "sx", "sy", "sxx", "syy", "sxy"]

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(fields), len(names), len(names)))
        for batch in batches:
            x = batch.to_numpy(dtype="float64") - means
            held = ~np.isnan(x)
            x, held = np.where(held, x, 0.0), held.astype("float64")
            s, ss = x.T @ held, (x * x).T @ held
            total += np.stack([held.T @ held, s, s.T, ss, ss.T, x.T @ x])
        out = pd.DataFrame(total[:, i, j].T, columns=fields)
        out.insert(0, "j", j.astype("int32"))
        out.insert(0, "i", i.astype("int32"))
        yield out[out["n"] > 0]

    merged = (
        rows.mapInPandas(sums, "i int, j int, " + ", ".join(f"{f} double" for f in fields))
        .groupBy("i", "j")
        .agg(*[F.sum(f).alias(f) for f in fields])
    )
    spark = df.sparkSession
    pairs = local_table(spark, [(int(a), int(b), names[a], names[b]) for a, b in zip(i, j)], "i int, j int, column_a string, column_b string")
    r = "(n * sxy - sx * sy) / sqrt((n * sxx - sx * sx) * (n * syy - sy * sy))"
    return pairs.join(merged, ["i", "j"], "left").selectExpr(
        "column_a", "column_b", f"case when n * sxx - sx * sx > 0 and n * syy - sy * sy > 0 then {r} end as r"
    )


def sturges_bins(n: int) -> int:
    return max(5, int(1 + math.log2(n))) if n > 0 else 5


def histogram(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed, empty bins kept."""
    n, *ends = df.selectExpr(
        "count(*)", *[f"cast({f}({ident(c)}) as double)" for c in columns for f in ("min", "max")]
    ).first()
    k = sturges_bins(n)
    bins = {c: (low, high) for c, low, high in zip(columns, ends[::2], ends[1::2]) if low is not None}
    edges = []
    for c, (low, high) in bins.items():
        # A constant column gets one unit-wide range around its value.
        low, high = (low, high) if high > low else (low - 0.5, high + 0.5)
        edges += [(c, b, low, (high - low) / k) for b in range(k)]
    spark = df.sparkSession
    table = local_table(spark, edges, "column string, bin int, low double, width double")
    ranges = table.where("bin = 0").select("column", "low", "width")
    binned = (
        unpivot(df, columns)
        .where("value is not null")
        .join(F.broadcast(ranges), "column")
        .groupBy("column", F.expr(f"cast(least(floor((value - low) / width), {k - 1}) as int)").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    return table.join(binned, ["column", "bin"], "left").selectExpr(
        "column", "bin", "low + bin * width as bin_low", "low + (bin + 1) * width as bin_high", "coalesce(n, 0) as n"
    )


def boxplot_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (extreme points inside the fences) and flier count."""
    structs = []
    for c, q1, q2, q3, low, high in fences(df, columns):
        if low is None:
            continue
        x = f"cast({ident(c)} as double)"
        inside = f"{x} between {literal(low)} and {literal(high)}"
        structs.append(
            f"struct({text_literal(c)} as column, {literal(q1)} as q1, {literal(q2)} as median, {literal(q3)} as q3, "
            f"min(case when {inside} then {x} end) as whisker_low, max(case when {inside} then {x} end) as whisker_high, "
            f"count(case when not ({inside}) then 1 end) as fliers)"
        )
    return df.selectExpr(f"array({', '.join(structs)}) as rows").selectExpr("inline(rows)")


def grouped_median(df: DataFrame, group: str, target: str) -> DataFrame:
    """Exact median of the target per group."""
    medians = exact_percentiles(df, [target], [0.5], by=group)
    kind = df.schema[group].dataType.simpleString()
    rows = [(g, v[0]) for (g, _), v in medians.items()]
    return local_table(df.sparkSession, rows, f"`{group}` {kind}, median double")
