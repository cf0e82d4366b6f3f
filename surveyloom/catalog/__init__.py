"""The registered queries: each operator over the given tables, with its SQL."""

from surveyloom.catalog.registry import ORACLES, QUERIES
from surveyloom.catalog import tables, profile_queries, cluster_queries, model_queries, kernel_queries, study_queries  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
