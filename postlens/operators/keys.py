"""One row per key: latest, first, deduplicated and classified rows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First `n` rows per key in the given order.

    `row_number() <= n` lets Spark keep `n` rows per key in every map task before the shuffle, so a key that
    holds a third of all rows reaches its reducer as `n` rows per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def tie_break(df: DataFrame) -> list[Column]:
    """Every sortable column, so that of rows with equal ordinals the same one wins in every run."""
    return [F.col(f"`{name}`").asc() for name, kind in df.dtypes if not re.search("map|variant|void", kind)]


def dedupe_first(df: DataFrame, key: str, ordinal: str | Column) -> DataFrame:
    """First row of every non-empty key."""
    ordinal = F.col(ordinal) if isinstance(ordinal, str) else ordinal
    return top_per_key(df.filter(F.col(key) != ""), [key], [ordinal.asc(), *tie_break(df)])


def dedupe_last(df: DataFrame, key: str | Sequence[str], ordinal: str | Column) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    ordinal = F.col(ordinal) if isinstance(ordinal, str) else ordinal
    return top_per_key(df, keys, [ordinal.desc(), *tie_break(df)])


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, NULL keys ignored, with their row count."""
    present = df.dropna(subset=list(keys))
    return present.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")
