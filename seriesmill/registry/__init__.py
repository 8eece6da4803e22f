"""Registered queries: each operator on the given tables, with its SQL twin."""

from seriesmill.registry.book import ORACLES, QUERIES
from seriesmill.registry import cleaning, decisions, heavy, layers, learning, profiling, shaping, sourcing  # noqa: F401  isort: skip

__all__ = ["ORACLES", "QUERIES"]
