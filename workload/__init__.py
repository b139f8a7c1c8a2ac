"""The operators at work on the retail test tables, each with a check in SQL."""

from workload import conditions, drugs, history, report, scores  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
