"""Importing this module registers every query."""

from sitecast.catalog import q_joins, q_models, q_reports, q_sources, q_stats, q_time  # noqa: F401
from sitecast.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
