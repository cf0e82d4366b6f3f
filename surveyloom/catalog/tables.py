"""Queries: reading, row functions, cleaning, scaling, splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyloom.catalog.registry import query, table
from surveyloom.catalog.views import (
    AFFECT, CLEAN_CTE, ENGINEERED_CTE, FEATURES, LINE_COLUMNS, NUMERIC, SURVEY_CTE,
    clean_survey, engineered_survey, per_column, raw_survey,
)
from surveyloom.config import GAD_ITEMS, IMPUTED_COLUMNS, PHQ_ITEMS, PSS_ITEMS, SEVERITY_LABELS
from surveyloom.operators import features, sampling
from surveyloom.sources import read_table, split_xy


def rounded(df, columns, digits=6):
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


@query("read_table", sql="select event_id, user_id, event_type, value from events")
def _read_table(spark, sf_dir):
    return read_table(spark, f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", "value")


@query("split_xy", sql="select doc_id, quality, case when toxic = 0 then -1 else toxic end as toxic from labels")
def _split_xy(spark, sf_dir):
    return split_xy(table(spark, sf_dir, "labels"))


@query("derive_age", sql=f"with {SURVEY_CTE} select resp_id, least(greatest(2022 - year_of_birth, 14), 80) as age from survey")
def _derive_age(spark, sf_dir):
    return features.derive_age(raw_survey(spark, sf_dir)).select("resp_id", "age")


@query("composite_score", sql=f"with {ENGINEERED_CTE} select resp_id, pss_total, gad_total, phq9_total from engineered")
def _composite_score(spark, sf_dir):
    scored = features.composite_score(
        raw_survey(spark, sf_dir), {"pss_total": PSS_ITEMS, "gad_total": GAD_ITEMS, "phq9_total": PHQ_ITEMS}
    )
    return scored.select("resp_id", "pss_total", "gad_total", "phq9_total")


@query("bin_labels", sql=f"with {ENGINEERED_CTE} select resp_id, phq9_total, phq9_category from engineered")
def _bin_labels(spark, sf_dir):
    return engineered_survey(spark, sf_dir).select("resp_id", "phq9_total", "phq9_category")


@query("clean_column_names", sql="select c_custkey as custkey, c_acctbal as acctbal, c_mktsegment as segment from customer")
def _clean_column_names(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias(" CustKey"), F.col("c_acctbal").alias("AcctBal "), F.col("c_mktsegment").alias("SEGMENT")
    )
    return features.clean_column_names(c)


@query("impute_median", sql=f"with {CLEAN_CTE} select resp_id, {', '.join(IMPUTED_COLUMNS)} from clean")
def _impute_median(spark, sf_dir):
    e = raw_survey(spark, sf_dir).select("resp_id", *IMPUTED_COLUMNS)
    return features.impute_median(e, IMPUTED_COLUMNS)


@query(
    "drop_null_rows",
    sql=f"with {SURVEY_CTE} select resp_id, education_years_father, education_years_mother from survey "
    "where education_years_father is not null and education_years_mother is not null",
)
def _drop_null_rows(spark, sf_dir):
    return features.drop_null_rows(raw_survey(spark, sf_dir).select("resp_id", *IMPUTED_COLUMNS))


@query("numeric_columns", sql=f"with {CLEAN_CTE} select resp_id, {', '.join(FEATURES)} from clean")
def _numeric_columns(spark, sf_dir):
    return features.select_numeric(clean_survey(spark, sf_dir), exclude=["phq9_total"], keep=["resp_id"])


@query(
    "drop_constant_columns",
    sql="select event_id, user_id, value, length(event_type) as width from events",
)
def _drop_constant_columns(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "value", F.length("event_type").alias("width"),
        (F.col("user_id") * 0).alias("zero"), F.when(F.lit(False), 1.0).alias("empty"),
    )
    return features.drop_constant_columns(e, keep=["event_id"])


def _zscore(columns, source, fit=None):
    where = fit or source
    return ", ".join(
        f"round(({c} - (select avg({c}) from {where})) / (select stddev_pop({c}) from {where}), 6) as {c}" for c in columns
    )


_SCALED = ["age", "pss_total", "gad_total", "education_years_father"]


@query("standard_scale", sql=f"with {CLEAN_CTE} select resp_id, {_zscore(_SCALED, 'clean')} from clean")
def _standard_scale(spark, sf_dir):
    df = clean_survey(spark, sf_dir).select("resp_id", *_SCALED)
    return rounded(features.standard_scale(df, _SCALED), _SCALED)


HASH_SQL = "cast('0x' || substr(md5('{seed}:' || {key}), 1, 13) as bigint)"

# Largest-remainder quotas, then ranks of the key hash inside each class.
STRATIFIED_CTE = """
counts as (select phq9_category as c, count(*) as n from clean group by 1),
sizes as (select sum(n) as total, sum(n) - ceil(0.2 * sum(n)) as rest from counts),
share1 as (select c, n, n * rest / total as x, rest from counts, sizes),
rest_of as (select c, n, cast(floor(x) as bigint) + case when row_number() over (order by floor(x) - x, c)
   <= rest - sum(floor(x)) over () then 1 else 0 end as m, rest from share1),
share2 as (select c, n, m, rest - ceil(0.25 * rest) as keep, m * (rest - ceil(0.25 * rest)) / rest as x from rest_of),
quota as (select c, n, m, cast(floor(x) as bigint) + case when row_number() over (order by floor(x) - x, c)
   <= keep - sum(floor(x)) over () then 1 else 0 end as n_train from share2),
ranked as (select clean.*, row_number() over (partition by phq9_category order by HASH, resp_id) as rn from clean),
parts as (select ranked.*, case when rn <= n_train then 'train' when rn <= m then 'validation' else 'test' end as split
  from ranked join quota on phq9_category = c)""".replace("HASH", HASH_SQL.format(seed=42, key="resp_id"))


def split_survey(spark, sf_dir):
    return sampling.stratified_split(clean_survey(spark, sf_dir), "phq9_category", "resp_id")


@query(
    "standard_scale_fit_apply",
    sql=f"with {CLEAN_CTE}, {STRATIFIED_CTE}, train as (select * from parts where split = 'train') "
    f"select resp_id, split, {_zscore(_SCALED, 'parts', 'train')} from parts",
)
def _standard_scale_fit_apply(spark, sf_dir):
    parts = split_survey(spark, sf_dir).select("resp_id", "split", *_SCALED)
    scaled = features.standard_scale(parts, _SCALED, fit_on=parts.where("split = 'train'"))
    return rounded(scaled, _SCALED)


@query(
    "minmax_scale",
    sql="select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, "
    + ", ".join(
        f"round(({c} - (select min({c}) from lineitem)) / (select max({c}) - min({c}) from lineitem), 6) as {c}"
        for c in LINE_COLUMNS
    )
    + " from lineitem",
)
def _minmax_scale(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", *LINE_COLUMNS
    )
    return rounded(features.minmax_scale(li, LINE_COLUMNS), LINE_COLUMNS)


@query(
    "binarize_label_ovr",
    sql=f"with {CLEAN_CTE}, classes as (select unnest({SEVERITY_LABELS}) as class) "
    "select resp_id, class, case when phq9_category = class then 1 else -1 end as y from clean, classes",
)
def _binarize_label_ovr(spark, sf_dir):
    return features.binarize_label_ovr(
        clean_survey(spark, sf_dir), "phq9_category", SEVERITY_LABELS, keep=["resp_id"]
    )


@query(
    "binarize_dominant",
    sql="with top as (select o_orderpriority as c from orders group by 1 order by count(*) desc, 1 limit 1) "
    "select o_orderkey, case when o_orderpriority = (select c from top) then 1 else -1 end as y from orders",
)
def _binarize_dominant(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return features.binarize_dominant(o, "o_orderpriority").select("o_orderkey", "y")


@query(
    "label_encode",
    sql="with codes as (select event_type, cast(row_number() over (order by event_type) - 1 as int) as code "
    "from (select distinct event_type from events)) select event_id, event_type, code from events join codes using (event_type)",
)
def _label_encode(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    return features.label_encode(e, "event_type", out="code").select("event_id", "event_type", "code")


@query(
    "present_classes",
    sql=f"with {ENGINEERED_CTE}, ordered as (select unnest({SEVERITY_LABELS + ['Absent']}) as phq9_category, "
    f"unnest({list(range(6))}) as rank) select rank, phq9_category from ordered "
    "where phq9_category in (select phq9_category from engineered)",
)
def _present_classes(spark, sf_dir):
    return features.present_classes(engineered_survey(spark, sf_dir), "phq9_category", SEVERITY_LABELS + ["Absent"])


_EVENT_HASH = HASH_SQL.format(seed=42, key="event_id")


@query("sample_n", sql=f"select event_id, event_type, value from events order by {_EVENT_HASH}, event_id limit 500")
def _sample_n(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return sampling.sample_n(e, "event_id", 500)


@query("stratified_split", sql=f"with {CLEAN_CTE}, {STRATIFIED_CTE} select resp_id, phq9_category, split from parts")
def _stratified_split(spark, sf_dir):
    return split_survey(spark, sf_dir).select("resp_id", "phq9_category", "split")


@query(
    "random_split",
    sql="with ranked as (select event_id, row_number() over (order by "
    + HASH_SQL.format(seed=0, key="event_id")
    + ", event_id) as rn, count(*) over () as n from events) "
    "select event_id, case when rn <= n - ceil(0.3 * n) then 'train' else 'test' end as split from ranked",
)
def _random_split(spark, sf_dir):
    return sampling.random_split(table(spark, sf_dir, "events").select("event_id"), "event_id")
