"""Named queries over the given tables, each with SQL that yields the same rows."""

from hourloom.catalog import checking, chunking, modelling, reading, shaping  # noqa: F401
from hourloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
