"""Registered queries over the given tables."""

from tidelog.plans import acks, published, publishing, reading, recovery, streams
from tidelog.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "acks", "published", "publishing", "reading", "recovery", "streams"]
