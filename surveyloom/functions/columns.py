"""Small column-expression helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import NumericType, StructType


def quote(name: str) -> Column:
    """A column by its exact name, also when it holds dots or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of the numeric columns in schema order, minus ``exclude``."""
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType) and f.name not in skip]


def unpivot(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), *, as_type: str = "double") -> DataFrame:
    """Long form (by…, column, value) of the named columns; nulls are kept."""
    values = [f"cast({ident(c)} as {as_type}) as {ident(c)}" for c in columns]
    return df.selectExpr(*[ident(b) for b in by], *values).unpivot(
        list(by), list(columns), "column", "value"
    )


def ident(name: str) -> str:
    """A column name quoted for SQL text.

    Generated expressions are built as SQL text and parsed once: building the
    same tree operator by operator costs milliseconds per node on the driver.
    """
    return "`" + name.replace("`", "``") + "`"


def literal(x: float) -> str:
    """A double literal for SQL text, exact to the last bit."""
    return f"({float(x)!r}D)"


def text_literal(value) -> str:
    """A literal of a label (string, number or boolean) for SQL text."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def hash52(key: str, seed: int | str) -> str:
    """SQL text: a 52-bit number from md5(seed:key); uniform, exact in a double."""
    return f"cast(conv(substring(md5(concat('{seed}:', cast({ident(key)} as string))), 1, 13), 16, 10) as bigint)"


HASH52_RANGE = 1 << 52


def sq_dist(columns: Sequence[str], centre: Sequence[float]) -> str:
    """SQL text: squared Euclidean distance to a constant point, one flat sum."""
    terms = []
    for c, v in zip(columns, centre):
        d = f"({ident(c)} - {literal(v)})"
        terms.append(f"{d} * {d}")
    return "(" + " + ".join(terms) + ")"


def dot(columns: Sequence[str], weights: Sequence[float]) -> str:
    """SQL text: inner product with constant weights."""
    return "(" + " + ".join(f"{ident(c)} * {literal(w)}" for c, w in zip(columns, weights)) + ")"


def doubles(df: DataFrame, columns: Sequence[str], *, keep: Sequence[str] = ()) -> DataFrame:
    """The ``keep`` columns as they are and the named columns as doubles."""
    return df.selectExpr(*[ident(k) for k in keep], *[f"cast({ident(c)} as double) as {ident(c)}" for c in columns])


def complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows whose (double) features are neither null nor NaN."""
    return df.where(" and ".join(f"not isnan(coalesce({ident(c)}, double('NaN')))" for c in columns))


def value_or_null(x: float | None) -> float | None:
    """NaN and None both become None."""
    return None if x is None or x != x else float(x)


def local_table(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A small driver-side table (parameters, labels, reports) as a DataFrame."""
    schema = StructType.fromDDL(ddl)
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    arrays = [pa.array(list(c), type=to_arrow_type(f.dataType)) for c, f in zip(columns, schema)]
    return spark.createDataFrame(pa.table(arrays, names=schema.names), schema)
