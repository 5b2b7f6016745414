"""Registered queries over the given tables. Importing a module registers its queries."""

from checks import loading, market, merging, pages  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
