"""All registered queries."""

from labelscope.plans import model_queries, score_queries, text_queries  # noqa: F401
from labelscope.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
