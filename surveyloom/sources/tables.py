"""Reading tables and shaping labelled feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType


def read_table(
    spark: SparkSession,
    path: str,
    *,
    format: str | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Read a CSV (with header) or parquet table; NaN becomes NULL.

    A CSV without ``schema`` is read twice, because its types are inferred; give
    the schema for large inputs.  A missing path is reported by Spark itself.
    """
    fmt = format or ("csv" if path.rstrip("/").lower().endswith((".csv", ".csv.gz")) else "parquet")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
    return nan_to_null(reader.format(fmt).load(path))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in floating-point columns, so one missing value exists."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    if not floats:
        return df
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floats})


def split_xy(df: DataFrame, *, label: str | None = None) -> DataFrame:
    """Features are all columns but the label (default: the last); label 0 → −1."""
    y = label or df.columns[-1]
    return df.select(
        *[c for c in df.columns if c != y],
        F.when(F.col(y) == 0, -1).otherwise(F.col(y)).alias(y),
    )
