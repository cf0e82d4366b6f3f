"""Sinks: long metrics tables as JSON, and plot-data tables as parquet."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions import local_table

METRIC_COLUMNS = ["task", "model", "split", "class", "metric", "value"]
MAX_REPORT_ROWS = 100_000


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    """Write the long metrics table as JSON lines (distributed)."""
    metrics.select(*METRIC_COLUMNS).write.mode("overwrite").json(path)


def metrics_to_json(metrics: DataFrame) -> DataFrame:
    """One JSON object per (task, model): the nested view of the long table.

    Metrics without a class sit beside a ``classes`` object, metrics without a
    split beside the splits.  Grouped twice, so no group holds more than one
    model's report.
    """
    entry = F.struct(F.coalesce("class", F.lit("overall")), F.col("metric"), F.col("value"))
    ordered = F.sort_array(F.collect_list(entry.alias("e")))
    per_class = F.transform(
        ordered,
        lambda e: F.struct(
            e["col1"].alias("class"), e["metric"].alias("metric"), e["value"].alias("value")
        ),
    )
    by_split = metrics.groupBy("task", "model", F.coalesce("split", F.lit("all")).alias("split")).agg(
        per_class.alias("entries")
    )
    pairs = F.sort_array(F.collect_list(F.struct("split", "entries")))
    return by_split.groupBy("task", "model").agg(
        F.to_json(F.map_from_entries(pairs)).alias("report")
    )


def write_metrics_document(metrics: DataFrame, path: str, *, extra: dict[str, Any] | None = None) -> dict:
    """Write one indented JSON document, task → model → split → metric, as the one text file in ``path``.

    Spark writes it, so any file system it reaches will do. The long table holds
    one row per model, split, class and metric, so it is small by construction; a
    larger one is refused rather than truncated.
    """
    rows = metrics.select(*METRIC_COLUMNS).limit(MAX_REPORT_ROWS + 1).collect()
    if len(rows) > MAX_REPORT_ROWS:
        raise ValueError("metrics table too large for one document; use write_metrics_json")
    document = nest_metrics(rows)
    document.update(extra or {})
    text = local_table(metrics.sparkSession, [(json.dumps(document, indent=4),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(path)
    return document


def nest_metrics(rows) -> dict:
    """Nest long metric rows: overall metrics beside per-class ones."""
    document: dict = {}
    for r in sorted(rows, key=lambda r: tuple("" if v is None else str(v) for v in r[:5])):
        node = document.setdefault(r["task"], {}).setdefault(r["model"], {})
        for level in (r["split"], r["class"]):
            if level is not None:
                node = node.setdefault(level, {})
        node[r["metric"]] = r["value"]
    return document


def write_plot_data(tables: dict[str, DataFrame], path: str) -> None:
    """Write each plot-data table under ``path``/<name> as parquet."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{name}")
