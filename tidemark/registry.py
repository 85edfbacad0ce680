"""The registered queries: name to callable, and name to the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from tidemark.plans import capture_queries, event_queries, rule_queries, stream_queries  # noqa: F401  they register themselves
from tidemark.plans.book import ORACLE_SQL, QUERIES

FLAGSHIP = "capture_events"

__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES"]
