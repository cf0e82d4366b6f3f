"""Leaderboards and listings from the long metrics table.

The table has one row per (task, model, split, class, metric): a few thousand
at most, so every report below works on it as a small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_SPLITS = (("Validation", "Val"), ("Test", "Test"))
_BOARDS = {
    "Clustering": (("N_Clusters", "Silhouette", "Davies_Bouldin"), "Silhouette"),
    "Regression": (("R2", "RMSE", "MAE", "MSE"), "Val_R2"),
    "Classification": (("Accuracy", "Macro_F1"), "Val_Accuracy"),
}


def model_leaderboard(metrics: DataFrame, task: str) -> DataFrame:
    """One row per model, splits side by side, best first (nulls last, then by name)."""
    names, order = _BOARDS[task]
    rows = metrics.where((F.col("task") == task) & F.col("class").isNull())
    if task == "Clustering":
        wanted = {m: f"max(case when metric = '{m}' then value end)" for m in names}
    else:
        wanted = {
            f"{short}_{m.replace('_', '')}": f"max(case when metric = '{m}' and split = '{split}' then value end)"
            for split, short in _SPLITS
            for m in names
        }
    board = rows.groupBy("model").agg(*[F.expr(f"{sql} as {name}") for name, sql in wanted.items()])
    return board.orderBy(F.desc_nulls_last(order), "model")


def sens_spec_table(metrics: DataFrame) -> DataFrame:
    """Sensitivity and specificity per model, split and class; missing splits absent."""
    rows = metrics.where("task = 'Classification' and metric in ('Sensitivity', 'Specificity')")
    return rows.groupBy("model", "split", "class").agg(
        F.expr("max(case when metric = 'Sensitivity' then value end) as sensitivity"),
        F.expr("max(case when metric = 'Specificity' then value end) as specificity"),
    )


def best_model(metrics: DataFrame, *, metric: str = "Accuracy", split: str = "Validation") -> DataFrame:
    """The model with the highest value; the first by name on a tie."""
    rows = metrics.where((F.col("metric") == metric) & (F.col("split") == split) & F.col("class").isNull())
    return rows.orderBy(F.desc("value"), "model").select("model", "value").limit(1)


def model_comparison(metrics: DataFrame, metric: str, *, split: str = "Validation") -> DataFrame:
    """(position, model, value) ascending, ties by name: the bars of a comparison chart."""
    rows = metrics.where((F.col("metric") == metric) & (F.col("split") == split) & F.col("class").isNull())
    order = Window.orderBy("value", "model")
    return rows.select(F.row_number().over(order).alias("position"), "model", "value")
