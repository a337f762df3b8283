"""Queries over the given tables, one per operator, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str):
    """Register a query under `name` with the SQL that gives the same rows."""
    def register(fn):
        QUERIES[name] = fn
        ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load() -> None:
    from workload import aggregates, hierarchies, relations, scalars, scans, timeseries  # noqa: F401
