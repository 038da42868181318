"""Sharding by a Hilbert curve over several metadata columns.

Every column is quantised into equally filled cells (boundaries from one sketch over all rows; texts stand for their
rank among the column's distinct values, whatever prefix they share), the cells of a row give
its place on the curve, rows are sorted by it, and the sorted sequence is cut into runs of equal row counts. Files cut
this way have narrow ranges in all of the columns at once, so readers prune on any of them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.frames import without
from postlens.operators.ranking import rank_many
from postlens.session import materialise

SHARDS, BITS, ACCURACY = 16, 8, 10000
DIMENSIONS = ("lang", "source", "n_chars")
RESULT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def with_ordinals(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """`df` with a number `_o0`, `_o1`, ... for each column that orders like it: the rank of a text among the column's
    distinct values (by bytes), anything else as it is. Only the distinct values are ranked and joined back."""
    for i, name in enumerate(names):
        column, own = F.col(f"`{name}`"), f"_o{i}"
        if isinstance(df.schema[name].dataType, (T.StringType, T.BinaryType)):
            values = df.select(column.cast("binary").alias("_value")).filter("_value IS NOT NULL").distinct()
            ranked = rank_many(values, [F.col("_value")], "_place").select("_value", F.col("_place").cast("double").alias(own))
            ranked = materialise(ranked, "ordinals")
            df = df.join(ranked, column.cast("binary") == ranked["_value"], "left").drop(ranked["_value"])
        else:
            df = df.withColumn(own, column.cast("double"))
    return df


def boundaries(df: DataFrame, count: int, bits: int, accuracy: int = ACCURACY) -> list[list[float]]:
    """For each of `count` ordinals the distinct quantiles that cut it into up to 2**bits cells of about equal size."""
    cuts = [i / 2**bits for i in range(1, 2**bits)]
    row = df.agg(*[F.percentile_approx(f"_o{i}", cuts, accuracy).alias(f"q{i}") for i in range(count)]).first()
    return [sorted(set(q or ())) for q in row]


def cells(values: np.ndarray, cuts: list[float], bits: int) -> np.ndarray:
    """Cell of each value, spread over the whole range of 2**bits; NULL falls in the first cell."""
    at = np.where(np.isnan(values), 0, np.searchsorted(cuts, values, side="left") + 1)
    return at.astype(np.int64) * (2**bits - 1) // (len(cuts) + 1)


def curve_index(coordinates: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points given as rows of `bits`-bit coordinates (the transposed-bits transform)."""
    x = coordinates.astype(np.int64).T.copy()
    dimensions, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(dimensions):
            swap = np.where(x[i] & q, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(x[i] & q, low, 0) ^ swap
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, dimensions):
        x[i] ^= x[i - 1]
    turn, q = np.zeros_like(x[0]), top
    while q > 1:
        turn ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dimensions):
            index = index << 1 | (x[i] >> bit & 1)
    return index


def place_on_curve(df: DataFrame, count: int, bits: int = BITS) -> Column:
    """Curve index of each row of a table with `count` ordinals."""
    cuts = boundaries(df, count, bits)

    @F.pandas_udf(T.LongType())
    def place(*columns: pd.Series) -> pd.Series:
        points = [cells(c.to_numpy(dtype=float), q, bits) for c, q in zip(columns, cuts)]
        return pd.Series(curve_index(np.stack(points, axis=1), bits))

    return place(*[F.col(f"_o{i}") for i in range(count)])


def shard_by_curve(
    docs: DataFrame,
    dimensions: Sequence[str] = DIMENSIONS,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] | None = None,
    bits: int = BITS,
) -> DataFrame:
    """Every row of `docs` with its shard (0 to shards - 1) and its place in it (from 0, without gaps).

    Law `rows`: shard sizes differ by one row at most. Rows are ordered by the curve, then by text, so that equal texts
    with equal metadata lie together, then by id; rows equal in all of it are ordered arbitrarily. Adds `size` (UTF-8
    bytes of the text plus 1; NULL has none), `text_crc32`, `law`, `shard`, `slot` and `grown_shard` (NULL: this law
    moves rows when shards are added). NULL in a dimension counts as smallest. An empty table stays empty. Columns
    that clash with a result column are replaced (but used as dimensions); `carry` names the columns to return
    besides (default: all).
    """
    text = F.col(f"`{text_col}`")
    names = [c for c in without(docs, RESULT).columns if carry is None or c in carry]
    numbered = with_ordinals(docs, dimensions)
    placed = numbered.select(
        *[F.col(f"`{c}`") for c in names],
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        place_on_curve(numbered, len(dimensions), bits).alias("_curve"),
        F.xxhash64(text).alias("_text"),
        F.col(f"`{id_col}`").alias("_id"),
    ).withColumn("size", F.col("size") + 1)
    ranked = rank_many(placed, [F.col("_curve"), F.col("_text"), F.col("_id")], "_rank")
    rows = docs.count()
    zero_based = F.col("_rank") - 1
    return ranked.withColumn("shard", F.expr(f"(_rank - 1) * {shards} div {max(rows, 1)}L").cast("int")).select(
        *[F.col(f"`{c}`") for c in names],
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (zero_based - F.expr(f"(shard * {rows}L + {shards - 1}) div {shards}")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(sharded: DataFrame, folder: str) -> None:
    """One folder per shard, its rows in slot order."""
    ordered = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(folder)
