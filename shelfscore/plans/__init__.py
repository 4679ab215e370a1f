"""Registered queries and their SQL twins."""

from shelfscore.plans import feature_queries, model_queries, text_queries  # noqa: F401
from shelfscore.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
