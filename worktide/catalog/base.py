"""Registry of the queries that run over the given tables, each with its SQL check where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import spread_scan


class Tables:
    """The given Parquet tables by attribute: ``t.lineitem``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, name: str, key: str) -> DataFrame:
        """The table for work that is heavy per row."""
        return spread_scan(getattr(self, name), key)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name`` with its SQL check."""

    def add(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add
