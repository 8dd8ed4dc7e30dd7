"""Every operator bound to the test tables, each with the SQL that must give the same rows."""

from . import control, customers, dims, files, integrity, profiles, projection, ranking, silver, summaries, text, topics
from .registry import ORACLES, QUERIES

__all__ = [
    "ORACLES", "QUERIES", "control", "customers", "dims", "files", "integrity", "profiles", "projection", "ranking",
    "silver", "summaries", "text", "topics",
]
