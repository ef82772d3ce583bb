"""Registered queries, the views they read and their oracle SQL."""

from tidelog.plans import (  # noqa: F401
    archive_queries,
    catalog_queries,
    decode_queries,
    gtid_queries,
    log_queries,
    stream_queries,
)
from tidelog.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
