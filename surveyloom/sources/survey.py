"""The survey's declared schema and a survey-shaped view over ``orders``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from surveyloom.config import (
    GAD_ITEMS, NEGATIVE_AFFECT_ITEMS, PHQ_ITEMS, POSITIVE_AFFECT_ITEMS, PSS_ITEMS,
)
from surveyloom.functions import small_methods

_INT_HEAD = ["year_of_birth", "gender", "socioeconomic_status", "ethnicity"]
_EDUCATION = ["education_years_father", "education_years_mother"]
_AFFECT = POSITIVE_AFFECT_ITEMS + NEGATIVE_AFFECT_ITEMS

SURVEY_SCHEMA = StructType(
    [StructField(c, IntegerType()) for c in _INT_HEAD]
    + [StructField(c, DoubleType()) for c in _EDUCATION]
    + [StructField("life_satisfaction", IntegerType())]
    + [StructField(c, IntegerType()) for c in _AFFECT + PSS_ITEMS + GAD_ITEMS + PHQ_ITEMS]
)


def survey_from_orders(orders: DataFrame) -> DataFrame:
    """A survey-shaped table derived row by row from ``orders`` (key: resp_id)."""
    t = "cast(floor(o_totalprice / 125000) as bigint)"

    def item(top: int, modulus: int, shift: int) -> str:
        return f"cast(least({top}, greatest(0, t + (k % {modulus}) % 3 - {shift})) as int)"

    columns = {
        "year_of_birth": "cast(1973 + c % 50 as int)",
        "gender": "cast(1 + k % 2 as int)",
        "socioeconomic_status": "cast(1 + k % 6 as int)",
        "ethnicity": "cast(1 + (k * 5 + c) % 6 as int)",
        "education_years_father": "case when k % 3 <> 0 then cast(k % 44 as double) end",
        "education_years_mother": "case when k % 3 <> 1 then cast((k * 7) % 44 as double) end",
        "life_satisfaction": "cast(10 - 2 * t - k % 3 as int)",
    }
    for j, name in enumerate(POSITIVE_AFFECT_ITEMS, start=1):
        columns[name] = f"cast(10 - 2 * t - (k * {j}) % 4 as int)"
    for j, name in enumerate(NEGATIVE_AFFECT_ITEMS, start=5):
        columns[name] = f"cast(2 * t + (k * {j}) % 4 as int)"
    for i, name in enumerate(PSS_ITEMS, start=1):
        columns[name] = item(4, 2 * i + 37, 0)
    for i, name in enumerate(GAD_ITEMS, start=1):
        columns[name] = item(3, 2 * i + 23, 1)
    for i, name in enumerate(PHQ_ITEMS, start=1):
        columns[name] = item(3, 2 * i + 5, 1)
    small_methods(orders.sparkSession)
    base = orders.selectExpr("o_orderkey as k", "o_custkey as c", f"{t} as t")
    return base.selectExpr("k as resp_id", *[f"{sql} as {name}" for name, sql in columns.items()])
