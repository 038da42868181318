"""Small helpers the corpus operators share: column handling and Arrow batches of bounded size."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 2 << 20


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """`df` without the columns that a result of these names would clash with (names compare as Spark compares them)."""
    taken = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def utf8(text: Column) -> Column:
    """Bytes of a text; NULL stays NULL."""
    return text.cast("string").cast("binary")


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each hold about `limit` bytes; a longer text comes alone, no row is lost."""
    for batch in batches:
        at, size = 0, 0
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        for row, length in enumerate(lengths):
            if size and size + length > limit:
                yield batch.slice(at, row - at)
                at, size = row, 0
            size += int(length)
        if at < batch.num_rows:
            yield batch.slice(at)
