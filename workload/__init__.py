"""Queries over the given tables, each with equivalent SQL where SQL can express it."""

from workload import columns, files, retail, social, streams  # noqa: F401
from workload.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
