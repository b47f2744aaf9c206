"""Batch operators, grouped by the tables they work on."""

from . import blocks, catalog, integrity, metrics, objects, state

__all__ = ["blocks", "catalog", "integrity", "metrics", "objects", "state"]
