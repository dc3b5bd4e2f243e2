"""Registered queries and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register a function (spark, table) -> DataFrame; ``table(name)`` reads one of the given tables."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        run.__name__, run.__doc__ = key, f.__doc__
        QUERIES[key] = run
        if sql:
            ORACLES[key] = sql
        return f

    return add


from . import fields, joins, pages, rollups, scans  # noqa: E402,F401
