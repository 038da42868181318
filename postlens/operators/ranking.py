"""Row numbers over a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.session import materialise

_POSITION_BITS = 33  # monotonically_increasing_id: partition number above, position in the partition below


def rank_few(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Row number of a table whose size is bounded by a fixed value list (bands, levels, categories, cities)."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def rank_many(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Row number of a table of any size, without sorting it in one task.

    The table is range-sorted and written once to the shared folder; the row number is the position inside a
    sorted partition plus the size of the partitions before it. The offsets table has one row per partition.
    """
    position = F.monotonically_increasing_id()
    placed = materialise(df.orderBy(*order).withColumn("_position", position), "ranked")
    partition = F.shiftright("_position", _POSITION_BITS)
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(partition.alias("_partition"))
        .agg(F.count("*").alias("_rows"))
        .select("_partition", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    inside = F.col("_position").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        placed.withColumn("_partition", partition)
        .join(offsets, "_partition")
        .withColumn(name, F.col("_offset") + inside + 1)
        .drop("_partition", "_position", "_offset")
    )
