"""Queries over the test tables, each next to the SQL that gives the same rows."""

from . import features, layers, models, reports, scores  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
