"""Every operator and pipeline as a query over the provided tables.

Each query has an equivalent SQL text with the same column names and types, for
comparison with an independent engine. All queries read whole tables.
"""

from __future__ import annotations

from tallylake.catalogue import daily, dimensional, discovery, ingest, relational  # noqa: F401  (registration)
from tallylake.catalogue.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
