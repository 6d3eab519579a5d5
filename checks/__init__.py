"""Registered queries over the test tables, each with its SQL counterpart."""

from . import analyses, batch, dedup, deliveries, functions, marts, profile, quality, relational, sources, star, streams
from .registry import ORACLES, QUERIES

__all__ = [
    "ORACLES", "QUERIES", "analyses", "batch", "dedup", "deliveries", "functions", "marts", "profile",
    "quality", "relational", "sources", "star", "streams",
]
