"""All queries over the test tables, each with the SQL it is checked against."""

from . import actions, nested, planning, projections, scans, summaries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
