"""All registered queries."""

from __future__ import annotations

from . import flowqueries, reshape, sinkqueries, sourcequeries, statequeries, streamqueries  # noqa: F401
from .flowqueries import land_counts
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "land_counts"]
