"""All queries of the engine with the SQL they are checked against."""

from registry import audits, jobs, live, series  # noqa: F401
from registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
