"""Every registered query of the library, by its survey id, and its SQL."""

from __future__ import annotations

from waymark.plans import columns, graph_queries, measures, questions, streams  # noqa: F401  registered on import
from waymark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
