"""All registered queries: importing the modules fills the registry."""

from __future__ import annotations

from hindcast.plans import queries_features, queries_inputs, queries_scores
from hindcast.plans.registry import QUERIES, SQL

MODULES = (queries_inputs, queries_features, queries_scores)
flagship = queries_scores.base_rate_slice

__all__ = ["MODULES", "QUERIES", "SQL", "flagship"]
