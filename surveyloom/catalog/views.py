"""Views over the given tables, in Spark and in SQL with the same arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from surveyloom.catalog.registry import table
from surveyloom.config import (
    GAD_ITEMS, IMPUTED_COLUMNS, NEGATIVE_AFFECT_ITEMS, PHQ_ITEMS, POSITIVE_AFFECT_ITEMS, PSS_ITEMS,
    SEVERITY_EDGES, SEVERITY_LABELS,
)
from surveyloom.plans.study import clean, engineer
from surveyloom.sources import survey_from_orders

LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
AFFECT = POSITIVE_AFFECT_ITEMS + NEGATIVE_AFFECT_ITEMS
NUMERIC = (
    ["gender", "socioeconomic_status", "ethnicity", *IMPUTED_COLUMNS, "life_satisfaction"]
    + AFFECT + ["age", "pss_total", "gad_total", "phq9_total"]
)
FEATURES = [c for c in NUMERIC if c != "phq9_total"]
DIM = 64
VEC = [f"x{i}" for i in range(DIM)]


def raw_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey_from_orders(table(spark, sf_dir, "orders"))


def engineered_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engineer(raw_survey(spark, sf_dir))


def clean_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(engineered_survey(spark, sf_dir))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` with one double column per dimension."""
    e = table(spark, sf_dir, "embeddings")
    return e.selectExpr(
        "vec_id", "cast(label as int) as label",
        *[f"cast(embedding[{i}] as double) as {c}" for i, c in enumerate(VEC)],
    )


def _item(name: str, top: int, modulus: int, shift: int) -> str:
    return f"cast(least({top}, greatest(0, t + (k % {modulus}) % 3 - {shift})) as int) as {name}"


_SURVEY_COLUMNS = (
    ["k as resp_id", "cast(1973 + c % 50 as int) as year_of_birth", "cast(1 + k % 2 as int) as gender",
     "cast(1 + k % 6 as int) as socioeconomic_status", "cast(1 + (k * 5 + c) % 6 as int) as ethnicity",
     "case when k % 3 <> 0 then cast(k % 44 as double) end as education_years_father",
     "case when k % 3 <> 1 then cast((k * 7) % 44 as double) end as education_years_mother",
     "cast(10 - 2 * t - k % 3 as int) as life_satisfaction"]
    + [f"cast(10 - 2 * t - (k * {j}) % 4 as int) as {c}" for j, c in enumerate(POSITIVE_AFFECT_ITEMS, 1)]
    + [f"cast(2 * t + (k * {j}) % 4 as int) as {c}" for j, c in enumerate(NEGATIVE_AFFECT_ITEMS, 5)]
    + [_item(c, 4, 2 * i + 37, 0) for i, c in enumerate(PSS_ITEMS, 1)]
    + [_item(c, 3, 2 * i + 23, 1) for i, c in enumerate(GAD_ITEMS, 1)]
    + [_item(c, 3, 2 * i + 5, 1) for i, c in enumerate(PHQ_ITEMS, 1)]
)
SURVEY_CTE = (
    "base as (select o_orderkey as k, o_custkey as c, cast(floor(o_totalprice / 125000) as bigint) as t from orders),\n"
    f"survey as (select {', '.join(_SURVEY_COLUMNS)} from base)"
)


def _total(items: list[str], name: str) -> str:
    return f"{' + '.join(f'coalesce({c}, 0)' for c in items)} as {name}"


CATEGORY_SQL = (
    f"case when phq9_total is null or phq9_total <= {SEVERITY_EDGES[0]} or phq9_total > {SEVERITY_EDGES[-1]} then 'nan' "
    + " ".join(f"when phq9_total <= {e} then '{s}'" for e, s in zip(SEVERITY_EDGES[1:], SEVERITY_LABELS))
    + " end"
)
ENGINEERED_CTE = (
    SURVEY_CTE + ",\nscored as (select resp_id, gender, socioeconomic_status, ethnicity, education_years_father, "
    f"education_years_mother, life_satisfaction, {', '.join(AFFECT)}, "
    "least(greatest(2022 - year_of_birth, 14), 80) as age, "
    f"{_total(PSS_ITEMS, 'pss_total')}, {_total(GAD_ITEMS, 'gad_total')}, {_total(PHQ_ITEMS, 'phq9_total')} from survey),\n"
    f"engineered as (select *, {CATEGORY_SQL} as phq9_category from scored)"
)
CLEAN_CTE = (
    ENGINEERED_CTE + ",\nclean as (select resp_id, gender, socioeconomic_status, ethnicity, "
    + ", ".join(f"coalesce({c}, (select median({c}) from engineered)) as {c}" for c in IMPUTED_COLUMNS)
    + f", life_satisfaction, {', '.join(AFFECT)}, age, pss_total, gad_total, phq9_total, phq9_category from engineered)"
)
VECTORS_CTE = (
    "vectors as (select vec_id, cast(label as int) as label, "
    + ", ".join(f"cast(embedding[{i + 1}] as double) as {c}" for i, c in enumerate(VEC))
    + " from embeddings)"
)


def per_column(columns: list[str], body: str, source: str) -> str:
    """``body`` for each column, with {c} as the column, all united."""
    return "\nunion all ".join(f"select '{c}' as \"column\", {body.format(c=c)} from {source}" for c in columns)
