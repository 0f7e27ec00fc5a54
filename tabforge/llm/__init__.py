"""Operators for the preparation of training data, with their queries and SQL statements."""

from .queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
