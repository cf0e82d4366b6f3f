"""Queries: plot data, metric export, and the whole study."""

from __future__ import annotations

from surveyloom.catalog.cluster_queries import standardised_survey
from surveyloom.catalog.model_queries import CONFIG, metrics_table
from surveyloom.catalog.registry import query
from surveyloom.catalog.tables import HASH_SQL, rounded
from surveyloom.catalog.views import CLEAN_CTE, FEATURES, NUMERIC, clean_survey, per_column, raw_survey
from surveyloom.functions import scratch_path
from surveyloom.operators import cluster, plotdata, profile
from surveyloom.plans.full import full_study
from surveyloom.plans.study import clean, engineer
from surveyloom.plans.supervised import run_supervised
from surveyloom.plans.unsupervised import cluster_scatter, run_unsupervised
from surveyloom.sources import metrics_to_json, write_plot_data

_SAMPLE = (
    f"{CLEAN_CTE}, drawn as (select * from clean order by {HASH_SQL.format(seed=42, key='resp_id')}, resp_id limit 50000)"
)


@query("scatter_sample", sql=f"with {_SAMPLE} " + per_column(FEATURES, "resp_id, cast({c} as double) as x, phq9_total as y", "drawn"))
def _scatter_sample(spark, sf_dir):
    return plotdata.scatter_sample(clean_survey(spark, sf_dir), "resp_id", FEATURES, "phq9_total")[0]


@query("scatter_correlation", sql=f"with {_SAMPLE} " + per_column(FEATURES, "round(corr({c}, phq9_total), 6) as r", "drawn"))
def _scatter_correlation(spark, sf_dir):
    points, r = plotdata.scatter_sample(clean_survey(spark, sf_dir), "resp_id", FEATURES, "phq9_total")
    return rounded(r, ["r"])


@query("elbow_series")
def _elbow_series(spark, sf_dir):
    return plotdata.series(cluster.kmeans_sweep(standardised_survey(spark, sf_dir), "resp_id", FEATURES)[0], "inertia")


@query("silhouette_series")
def _silhouette_series(spark, sf_dir):
    return plotdata.series(cluster.kmeans_sweep(standardised_survey(spark, sf_dir), "resp_id", FEATURES)[0], "silhouette")


@query("cluster_scatter")
def _cluster_scatter(spark, sf_dir):
    s = standardised_survey(spark, sf_dir)
    fit = cluster.partition.best_kmeans(s, FEATURES, [5])[5]
    labels = cluster.kmeans_fit(s, "resp_id", FEATURES, fit).withColumnRenamed("cluster", "KMeans")
    return cluster_scatter(clean_survey(spark, sf_dir), labels, CONFIG)


@query("metrics_json")
def _metrics_json(spark, sf_dir):
    return metrics_to_json(metrics_table(spark, sf_dir))


@query("plot_data_sink")
def _plot_data_sink(spark, sf_dir):
    path = scratch_path(spark, "plots")
    df = clean_survey(spark, sf_dir)
    write_plot_data(
        {"histogram": profile.histogram(df, NUMERIC), "correlation": profile.correlation_matrix(df, NUMERIC)}, path
    )
    return spark.read.parquet(f"{path}/histogram")


@query("eda_study", sql=f"with {CLEAN_CTE} select resp_id, {', '.join(NUMERIC)}, phq9_category from clean")
def _eda_study(spark, sf_dir):
    return clean(engineer(raw_survey(spark, sf_dir))).select("resp_id", *NUMERIC, "phq9_category")


@query("unsupervised_study")
def _unsupervised_study(spark, sf_dir):
    return run_unsupervised(clean_survey(spark, sf_dir), CONFIG)[0]


@query("supervised_study")
def _supervised_study(spark, sf_dir):
    return run_supervised(clean_survey(spark, sf_dir), CONFIG, label="phq9_category")


@query("full_study")
def _full_study(spark, sf_dir):
    return full_study(raw_survey(spark, sf_dir), CONFIG)
