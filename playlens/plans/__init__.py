"""Whole jobs, and the queries that run the operators on the given tables."""

from playlens.plans import batch, models, streams
from playlens.plans.registry import QUERIES

__all__ = ["QUERIES", "batch", "models", "streams"]
