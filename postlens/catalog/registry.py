"""Where the catalog modules put their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postlens.sources.tables import spread_small

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without `sql` it has no SQL counterpart and is covered by the unit tests alone."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str, spread: tuple[str, ...] = ()) -> DataFrame:
    """A driver table; `spread` names key columns of a table whose rows are costly to process."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread_small(df, *spread) if spread else df
