"""The feature-engineering and cleaning steps of the study."""

from __future__ import annotations

from pyspark.sql import DataFrame

from surveyloom.config import GAD_ITEMS, IMPUTED_COLUMNS, PHQ_ITEMS, PSS_ITEMS, SurveyConfig
from surveyloom.functions import small_methods
from surveyloom.operators import features


def engineer(raw: DataFrame, config: SurveyConfig = SurveyConfig()) -> DataFrame:
    """Age, three questionnaire totals and the severity band; sources dropped."""
    small_methods(raw.sparkSession)
    df = features.derive_age(raw)
    df = features.composite_score(
        df, {"pss_total": PSS_ITEMS, "gad_total": GAD_ITEMS, config.target: PHQ_ITEMS}
    )
    return features.bin_labels(df, config.target, out=config.category)


def clean(df: DataFrame) -> DataFrame:
    """Clean names, impute the education years, drop rows still holding nulls."""
    df = features.clean_column_names(df)
    return features.drop_null_rows(features.impute_median(df, IMPUTED_COLUMNS))
