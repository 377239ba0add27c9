"""The registered queries."""

from tidetable.plans import columns, grouping, loads, reads
from tidetable.plans.registry import QUERIES, TABLES, Query

__all__ = ["QUERIES", "TABLES", "Query", "columns", "grouping", "loads", "reads"]
