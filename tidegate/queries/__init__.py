"""Every operator as a named query over the given tables, with its SQL twin."""

from tidegate.queries import alerts, drift, layout, model, profile, ranges, rows, streams, summaries  # noqa: F401
from tidegate.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
