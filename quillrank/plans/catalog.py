"""All registered queries."""

from . import bandit_queries, ctr_queries, factor_queries, rating_queries, stream_queries, text_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
