"""Registered queries: every operator over the driver's tables."""

from tidemark.plans.queries import (  # noqa: F401
    cleaning, documents, loading, match_pages, names, slices, storage,
)
from tidemark.plans.queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
