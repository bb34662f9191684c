"""Registered queries over the test tables, each with its SQL twin where SQL can say it."""

from workload.registry import load_all, QUERIES, SQL

__all__ = ["load_all", "QUERIES", "SQL"]
