"""Registered queries over the given tables, each with the SQL that must agree with it."""

from catalog.base import ORACLES, QUERIES
from catalog import corpus, features, model, splits, storage  # noqa: F401  (they register themselves)

__all__ = ["ORACLES", "QUERIES"]
