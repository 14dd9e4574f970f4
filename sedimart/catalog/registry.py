"""Registry of queries and their SQL, and access to the given tables."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sedimart.sources.landing import TABLES, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MODULES = ["merges", "histories", "picks", "profiles", "people_queries", "payload_queries", "joining", "linking_queries", "snapshot_queries", "landing_queries", "outbound_queries", "basics", "instances"]


class Tables:
    """The given tables of one folder, read on access."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return read_table(self.spark, self.folder, name)


def query(name: str, sql: str | None = None):
    """Register ``build(tables)`` under ``name``, with its SQL if it can be said in SQL."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def register_all() -> None:
    for module in MODULES:
        importlib.import_module(f"sedimart.catalog.{module}")


def day(col: Column | str) -> Column:
    """A date or timestamp as 'yyyy-MM-dd' text."""
    return F.date_format(col, "yyyy-MM-dd")


def moment(col: Column | str) -> Column:
    """A timestamp as text down to the microsecond."""
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def cents(col: Column | str) -> Column:
    """An amount rounded to cents, as DOUBLE."""
    return F.round(F.col(col) if isinstance(col, str) else col, 2)
