"""All registered queries and their DuckDB oracles."""

from amalgam.plans import domain, inputs, relational  # noqa: F401  registration
from amalgam.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
