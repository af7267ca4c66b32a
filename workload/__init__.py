"""The library's operators as queries over the test tables, each with the SQL that gives the same rows."""

from workload import contracts, history, jobs, mishaps, partitions, quality, scans, shaping, sinks, sql, temporal  # noqa: F401
from workload.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
