"""All queries for the wait-time operators, with their SQL twins."""

from __future__ import annotations

from queuescope.plans import core_queries, curve_queries, hours_queries, state_queries
from queuescope.plans.facts import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "core_queries", "curve_queries", "hours_queries", "state_queries"]
