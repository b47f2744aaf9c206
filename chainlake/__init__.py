"""Ledger indexing on Spark: records, archives, integrity, metrics and state."""

from . import functions, sinks, sources
from .operators import blocks, catalog, integrity, metrics, objects, state
from .session import get_session, scratch_dir

__all__ = [
    "blocks",
    "catalog",
    "functions",
    "get_session",
    "integrity",
    "metrics",
    "objects",
    "scratch_dir",
    "sinks",
    "sources",
    "state",
]
