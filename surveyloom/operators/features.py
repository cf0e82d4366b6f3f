"""Row functions, cleaning and scaling (projections; no shuffle but the fits)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.config import AGE_RANGE, REFERENCE_YEAR, SEVERITY_EDGES, SEVERITY_LABELS
from surveyloom.functions import (
    ident, literal, local_table, numeric_columns, quote, require_columns, text_literal,
)
from surveyloom.operators.ranks import exact_percentiles


def derive_age(
    df: DataFrame,
    *,
    source: str = "year_of_birth",
    age: str = "age",
    reference_year: int = REFERENCE_YEAR,
    bounds: tuple[int, int] = AGE_RANGE,
) -> DataFrame:
    """Reference year − birth year, clipped; the source is dropped, null stays null."""
    low, high = bounds
    clipped = f"least(greatest({reference_year} - {ident(source)}, {low}), {high})"
    return df.withColumn(age, F.expr(f"if({ident(source)} is null, null, {clipped})")).drop(source)


def composite_score(df: DataFrame, groups: dict[str, Sequence[str]], *, drop_items: bool = True) -> DataFrame:
    """Row sums over item groups, nulls counted as 0; the items are dropped."""
    for items in groups.values():
        require_columns(df, items)
    totals = {
        name: F.expr(" + ".join(f"coalesce({ident(c)}, 0)" for c in items)) for name, items in groups.items()
    }
    scored = df.withColumns(totals)
    return scored.drop(*[c for items in groups.values() for c in items]) if drop_items else scored


def bin_labels(
    df: DataFrame,
    column: str,
    *,
    edges: Sequence[float] = SEVERITY_EDGES,
    labels: Sequence[str] = SEVERITY_LABELS,
    out: str,
) -> DataFrame:
    """Right-closed bins (low, high]; null or out of range becomes "nan"."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    x = ident(column)
    bands = " ".join(f"when {x} <= {high} then {text_literal(label)}" for high, label in zip(edges[1:-1], labels))
    outside = f"{x} is null or {x} <= {edges[0]} or {x} > {edges[-1]}"
    return df.withColumn(out, F.expr(f"case when {outside} then 'nan' {bands} else {text_literal(labels[-1])} end"))


def clean_column_names(df: DataFrame) -> DataFrame:
    """Strip and lowercase the column names; a collision is an error."""
    names = [c.strip().lower() for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names collide after cleaning: {sorted(names)}")
    return df.toDF(*names)


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill nulls of the named columns that exist with their exact median."""
    present = [c for c in columns if c in df.columns]
    medians = exact_percentiles(df, present, [0.5]) if present else {}
    fills = {c: medians[(c,)][0] for c in present if (c,) in medians}
    return df.withColumns({c: F.coalesce(quote(c), F.lit(v)) for c, v in fills.items()}) if fills else df


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Drop rows holding any null; columns that cannot be null are not tested."""
    tests = [f"{ident(f.name)} is not null" for f in df.schema if f.nullable]
    return df.where(" and ".join(tests)) if tests else df


def null_row_counts(df: DataFrame) -> DataFrame:
    """Residual nulls: total cells, and rows that ``drop_null_rows`` removes."""
    nulls = " + ".join(f"cast({ident(c)} is null as bigint)" for c in df.columns)
    return df.selectExpr(f"{nulls} as nulls").selectExpr(
        "coalesce(sum(nulls), 0) as null_cells", "count(case when nulls > 0 then 1 end) as null_rows"
    )


def select_numeric(df: DataFrame, *, exclude: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """The numeric columns minus ``exclude``, after the ``keep`` columns (a key)."""
    names = [c for c in numeric_columns(df, exclude) if c not in keep]
    return df.select(*[quote(c) for c in [*keep, *names]])


def varying_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with more than one non-null value: min < max, one pass."""
    if not columns:
        return []
    row = df.selectExpr(*[f"min({ident(c)}) < max({ident(c)})" for c in columns]).first()
    return [c for c, varies in zip(columns, row) if varies]


def drop_constant_columns(df: DataFrame, *, keep: Sequence[str] = ()) -> DataFrame:
    names = [c for c in numeric_columns(df) if c not in keep]
    varying = varying_columns(df, names)
    return df.select(*[quote(c) for c in [*keep, *varying]])


@dataclass(frozen=True)
class Scaling:
    """Per column (shift, divisor); a zero divisor maps the column to 0."""

    columns: tuple[str, ...]
    shift: tuple[float, ...]
    divisor: tuple[float, ...]

    def expressions(self) -> list[str]:
        """SQL text of the scaled value of each column."""
        return [
            f"({ident(c)} - {literal(s)}) / {literal(d)}" if d else f"if({ident(c)} is null, null, 0.0D)"
            for c, s, d in zip(self.columns, self.shift, self.divisor)
        ]

    def apply(self, df: DataFrame) -> DataFrame:
        """Scale the fitted columns in place and keep the others."""
        return df.withColumns({c: F.expr(e) for c, e in zip(self.columns, self.expressions())})


def _fit(df: DataFrame, columns: Sequence[str], shift: str, divisor: str) -> Scaling:
    row = df.selectExpr(
        *[shift.format(ident(c)) for c in columns], *[divisor.format(ident(c)) for c in columns]
    ).first()
    values = [float(v or 0.0) for v in row]
    return Scaling(tuple(columns), tuple(values[: len(columns)]), tuple(values[len(columns) :]))


def fit_standard(df: DataFrame, columns: Sequence[str]) -> Scaling:
    """Mean and population standard deviation of each column, one pass."""
    return _fit(df, columns, "avg({0})", "stddev_pop({0})")


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> Scaling:
    return _fit(df, columns, "min({0})", "max({0}) - min({0})")


def standard_scale(df: DataFrame, columns: Sequence[str], *, fit_on: DataFrame | None = None) -> DataFrame:
    """Z-scores with population deviation; fit on ``fit_on`` (a training split) if given."""
    return fit_standard(fit_on if fit_on is not None else df, columns).apply(df)


def minmax_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return fit_minmax(df, columns).apply(df)


def binarize_label_ovr(df: DataFrame, label: str, classes: Sequence, *, keep: Sequence[str]) -> DataFrame:
    """One row per (row, class): y is +1 for the row's own class, −1 for the rest."""
    y = F.when(quote(label) == F.col("class"), 1).otherwise(-1)
    return df.select(
        *[quote(k) for k in keep], quote(label), F.explode(F.array(*[F.lit(c) for c in classes])).alias("class")
    ).select(*keep, "class", y.alias("y"))


def class_counts(df: DataFrame, label: str, *, limit: int = 10_000) -> list[tuple]:
    """(class, rows) in class order, nulls left out; a label has few classes."""
    rows = df.where(quote(label).isNotNull()).groupBy(quote(label).alias("c")).count().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{label} has more than {limit} classes")
    return sorted((r["c"], r["count"]) for r in rows)


def dominant_class(df: DataFrame, label: str):
    """The most common class; on a tie the lowest in label order."""
    return min(class_counts(df, label), key=lambda cn: (-cn[1], cn[0]))[0]


def binarize_dominant(df: DataFrame, label: str, *, out: str = "y") -> DataFrame:
    top = dominant_class(df, label)
    return df.withColumn(out, F.when(quote(label) == F.lit(top), 1).otherwise(-1))


def label_encode(df: DataFrame, label: str, *, out: str) -> DataFrame:
    """Integer codes in ascending label order, through a small broadcast table."""
    codes = [(c, i) for i, (c, _) in enumerate(class_counts(df, label))]
    field = df.schema[label].dataType.simpleString()
    table = local_table(df.sparkSession, codes, f"`{label}` {field}, `{out}` int")
    return df.join(F.broadcast(table), label, "left")


def present_classes(df: DataFrame, label: str, ordered: Sequence[str]) -> DataFrame:
    """The ordered labels that occur, with their rank in the given order."""
    ranks = local_table(df.sparkSession, list(enumerate(ordered)), f"rank int, `{label}` string")
    return ranks.join(df.select(label).distinct(), label, "left_semi").select("rank", label)
