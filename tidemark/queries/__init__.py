"""Queries that run each operator over the given tables, with the SQL to compare with."""

from __future__ import annotations

from tidemark.queries import extract, loading, merging, shaping, staging  # noqa: F401
from tidemark.queries.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
