"""Queries: descriptive statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveyloom.catalog.registry import query, table
from surveyloom.catalog.tables import rounded
from surveyloom.catalog.views import (
    CLEAN_CTE, ENGINEERED_CTE, FEATURES, LINE_COLUMNS, NUMERIC, clean_survey, engineered_survey, per_column,
)
from surveyloom.config import SHARE_COLUMNS
from surveyloom.operators import profile

_ALL = ["resp_id", *NUMERIC, "phq9_category"]


def _lineitem(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)


@query(
    "dataset_overview",
    sql=f"with {ENGINEERED_CTE} "
    + "\nunion all ".join(
        f"select '{c}' as \"column\", '{'categorical' if c == 'phq9_category' else 'numeric'}' as kind, "
        f"count(*) - count({c}) as nulls, count(*) as n_rows, {len(_ALL)} as n_columns from engineered"
        for c in _ALL
    ),
)
def _dataset_overview(spark, sf_dir):
    return profile.dataset_overview(engineered_survey(spark, sf_dir))


@query(
    "central_tendency",
    sql=f"with {CLEAN_CTE} " + per_column(NUMERIC, "round(avg({c}), 3) as mean, cast(median({c}) as double) as median", "clean"),
)
def _central_tendency(spark, sf_dir):
    return profile.central_tendency(clean_survey(spark, sf_dir), NUMERIC)


_MODE_COLUMNS = ["gender", "socioeconomic_status", "ethnicity", "age", "phq9_total", "life_satisfaction", "phq9_category"]


@query(
    "mode_all_ties",
    sql=f"with {CLEAN_CTE}, long as (" + per_column(_MODE_COLUMNS, "cast({c} as varchar) as value", "clean") + "), "
    "counts as (select \"column\", value, count(*) as n from long group by 1, 2) "
    "select \"column\", value, n from counts qualify rank() over (partition by \"column\" order by n desc) = 1",
)
def _mode_all_ties(spark, sf_dir):
    return profile.mode_all_ties(clean_survey(spark, sf_dir), _MODE_COLUMNS)


@query(
    "dispersion",
    sql=per_column(
        LINE_COLUMNS,
        "round(max({c}) - min({c}), 6) as range, round(var_samp({c}), 4) as variance, round(stddev_samp({c}), 4) as std_dev",
        "lineitem",
    ),
)
def _dispersion(spark, sf_dir):
    return rounded(profile.dispersion(_lineitem(spark, sf_dir), LINE_COLUMNS), ["range"])


_Q = {p: f"quantile_cont({{c}}, {p})" for p in (0.25, 0.5, 0.75)}


@query(
    "position_measures",
    sql="select \"column\", round(q1, 3) as q1, round(q2, 3) as q2, round(q3, 3) as q3, round(q3 - q1, 3) as iqr, "
    "round(q1 - 1.5 * (q3 - q1), 3) as lower_fence, round(q3 + 1.5 * (q3 - q1), 3) as upper_fence from ("
    + per_column(LINE_COLUMNS, f"{_Q[0.25]} as q1, {_Q[0.5]} as q2, {_Q[0.75]} as q3", "lineitem")
    + ")",
)
def _position_measures(spark, sf_dir):
    return profile.position_measures(_lineitem(spark, sf_dir), LINE_COLUMNS)


@query(
    "outlier_counts",
    sql=f"with {CLEAN_CTE} "
    + "\nunion all ".join(
        f"select '{c}' as \"column\", count(*) filter (where {c} < q1 - 1.5 * (q3 - q1) or {c} > q3 + 1.5 * (q3 - q1)) as outliers "
        f"from clean, (select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.75) as q3 from clean)"
        for c in NUMERIC
    ),
)
def _outlier_counts(spark, sf_dir):
    return profile.outlier_counts(clean_survey(spark, sf_dir), NUMERIC)


@query(
    "value_counts",
    sql=f"with {CLEAN_CTE}, long as (" + per_column(SHARE_COLUMNS, "cast({c} as varchar) as value", "clean") + ") "
    "select \"column\", value, count(*) as n, "
    "round(count(*) * 100.0::double / sum(count(*)) over (partition by \"column\"), 6) as percent from long group by 1, 2",
)
def _value_counts(spark, sf_dir):
    return rounded(profile.value_counts(clean_survey(spark, sf_dir), [*SHARE_COLUMNS, "absent"]), ["percent"])


@query(
    "pearson_vs_target",
    sql=f"with {CLEAN_CTE} " + per_column(FEATURES, "round(corr({c}, phq9_total), 6) as r", "clean"),
)
def _pearson_vs_target(spark, sf_dir):
    return rounded(profile.pearson_vs_target(clean_survey(spark, sf_dir), FEATURES, "phq9_total"), ["r"])


@query(
    "correlation_matrix",
    sql=f"with {CLEAN_CTE} "
    + "\nunion all ".join(
        f"select '{a}' as column_a, '{b}' as column_b, round(corr({a}, {b}), 6) as r from clean"
        for i, a in enumerate(NUMERIC) for b in NUMERIC[:i]
    ),
)
def _correlation_matrix(spark, sf_dir):
    return rounded(profile.correlation_matrix(clean_survey(spark, sf_dir), NUMERIC), ["r"])


_HIST = ["l_quantity", "l_extendedprice"]


@query(
    "histogram",
    sql="with k as (select greatest(5, cast(floor(1 + log2(count(*))) as int)) as k from lineitem), "
    + "stats as (" + per_column(_HIST, "min({c}) as low, max({c}) - min({c}) as span", "lineitem") + "), "
    + "bins as (select \"column\", low, span / k as width, k, unnest(range(k)) as bin from stats, k), "
    + "long as (" + per_column(_HIST, "{c} as value", "lineitem") + "), "
    + "counts as (select s.\"column\", least(floor((value - low) / (span / k)), k - 1) as bin, count(*) as n "
    "from long join stats s using (\"column\"), k group by 1, 2) "
    "select b.\"column\", cast(b.bin as int) as bin, round(low + b.bin * width, 4) as bin_low, "
    "round(low + (b.bin + 1) * width, 4) as bin_high, coalesce(n, 0) as n "
    "from bins b left join counts c on b.\"column\" = c.\"column\" and b.bin = c.bin",
)
def _histogram(spark, sf_dir):
    return rounded(profile.histogram(_lineitem(spark, sf_dir), _HIST), ["bin_low", "bin_high"], 4)


@query(
    "boxplot_stats",
    sql="\nunion all ".join(
        f"select '{c}' as \"column\", round(q1, 6) as q1, round(m, 6) as median, round(q3, 6) as q3, "
        f"min({c}) filter (where inside) as whisker_low, max({c}) filter (where inside) as whisker_high, "
        "count(*) filter (where not inside) as fliers from (select *, "
        f"{c} between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) as inside from {t}, "
        f"(select quantile_cont({c}, 0.25) as q1, quantile_cont({c}, 0.5) as m, quantile_cont({c}, 0.75) as q3 from {t})) "
        "group by q1, m, q3"
        for t, c in (("events", "value"), ("lineitem", "l_extendedprice"))
    ),
)
def _boxplot_stats(spark, sf_dir):
    events = profile.boxplot_stats(table(spark, sf_dir, "events"), ["value"])
    lines = profile.boxplot_stats(_lineitem(spark, sf_dir), ["l_extendedprice"])
    return rounded(events.unionByName(lines), ["q1", "median", "q3"])


@query("grouped_median", sql="select event_type, median(value) as median from events group by 1")
def _grouped_median(spark, sf_dir):
    return profile.grouped_median(table(spark, sf_dir, "events"), "event_type", "value")
