from surveyloom.sources.survey import SURVEY_SCHEMA, survey_from_orders
from surveyloom.sources.tables import read_table, split_xy
from surveyloom.sources.sinks import metrics_to_json, write_metrics_json, write_plot_data

__all__ = [
    "SURVEY_SCHEMA", "survey_from_orders", "read_table", "split_xy",
    "metrics_to_json", "write_metrics_json", "write_plot_data",
]
