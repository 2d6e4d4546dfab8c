"""Gathers every module's registered queries."""

from warren.plans import catalog_queries, filing_queries, graph_queries, neural_queries, series_queries, session_queries, sheet_queries, source_queries, summary_queries, track_queries, tuning_queries  # noqa: F401
from warren.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
