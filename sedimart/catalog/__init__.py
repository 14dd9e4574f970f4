"""Registered queries: each operator on the given tables, next to the SQL it is checked against."""

from sedimart.catalog.registry import ORACLES, QUERIES, register_all

register_all()

__all__ = ["ORACLES", "QUERIES"]
