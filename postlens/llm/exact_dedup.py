"""Exact deduplication: a two-pass Bloom filter lets rows that cannot repeat pass without a shuffle.

Pass one counts, for each of two hash functions, the slots of a filter that are hit at least twice. Pass two tests
every row against the two bitmaps: a row with a slot of its own is unique and passes straight through; only the rest
are grouped, by the SHA-256 of their normalised text. All of it is built-in functions.

The filter is a broadcast table of at most `2 ** max_bits` bits a function (16 MB by default), whatever the corpus
holds. Where that is no longer sparse more rows reach the grouping; the result never depends on the filter.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.frames import without
from postlens.session import materialise

MIN_BITS, MAX_BITS, SLOTS_PER_ROW = 15, 27, 16
#: Characters that normalisation deletes.
WHITE_SPACE = " \t\n\x0b\x0c\r"
RESULT = ("keep_id", "group_size", "kept", "text_sha256")
_WORK = ("_key", "_points", "_row", "_maybe")


def normalised(text: Column) -> Column:
    """Text without white space; NULL counts as empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), WHITE_SPACE, "")


def filter_bits(rows: int, max_bits: int = MAX_BITS) -> int:
    """Exponent of the filter's size: `SLOTS_PER_ROW` slots a row, within the bounds."""
    return min(max_bits, max(MIN_BITS, math.ceil(math.log2(max(1, rows) * SLOTS_PER_ROW))))


def _slot(function: int, bits: int) -> Column:
    """Slot, from 1, that a hash function gives a row: 56 bits of its digest, cut to the filter's size."""
    digest = F.conv(F.substring("_key", 1 + 14 * function, 14), 16, 10).cast("bigint")
    return digest % (1 << bits) + 1


def repeated_slots(rows: DataFrame, function: int, bits: int) -> DataFrame:
    """Bitmaps (bucket, bitmap) of the slots that at least two rows hit; counted per task before the shuffle."""
    twice = rows.groupBy(_slot(function, bits).alias("slot")).count().filter("count > 1")
    return twice.groupBy(F.bitmap_bucket_number("slot").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("_bitmap")
    )


def _is_set(bitmap: Column, position: Column) -> Column:
    byte = F.hex(F.substring(bitmap, F.floor(position / 8).cast("int") + 1, F.lit(1)))
    return F.coalesce(F.getbit(F.conv(byte, 16, 10).cast("int"), (position % 8).cast("int")) == 1, F.lit(False))


def flag_possible_repeats(rows: DataFrame, bits: int) -> DataFrame:
    """`rows` with `_maybe`: false only where the key occurs once."""
    flagged = rows.withColumn("_maybe", F.lit(True))
    for function in (0, 1):
        slot = _slot(function, bits)
        flagged = (
            flagged.withColumn("_bucket", F.bitmap_bucket_number(slot))
            .join(F.broadcast(repeated_slots(rows, function, bits)), "_bucket", "left")
            .withColumn("_maybe", F.col("_maybe") & _is_set(F.col("_bitmap"), F.bitmap_bit_position(slot)))
            .drop("_bucket", "_bitmap")
        )
    return flagged


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] | None = None, max_bits: int = MAX_BITS
) -> DataFrame:
    """Every row of `docs` with the row that stays of its group of equal texts.

    Texts are equal when identical without white space; NULL counts as empty, so empty, blank and NULL texts form one
    group. Of a group the text with the most code points stays, then the smallest id (NULL last), then, among rows
    that repeat both, one of them. `carry` names the columns to return besides the id (default: all). Columns that
    clash with a result column are replaced by it. An empty table gives an empty result.
    """
    id_name, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    kept_columns = without(docs, RESULT + _WORK).columns
    names = kept_columns if carry is None else [c for c in kept_columns if c in (*carry, id_col)]
    wanted = [F.col(f"`{c}`") for c in names]
    base = materialise(
        docs.select(
            *wanted,
            *([] if id_col in names else [id_name]),
            F.sha2(normalised(text), 256).alias("_key"),
            F.char_length(F.coalesce(text.cast("string"), F.lit(""))).alias("_points"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "dedup-base",
    )
    flagged = flag_possible_repeats(base, filter_bits(base.count(), max_bits))
    unique = flagged.filter("NOT _maybe").select(
        *wanted,
        id_name.alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("_key").alias("text_sha256"),
    )
    again = flagged.filter("_maybe")
    order = F.struct(-F.col("_points"), id_name.isNull(), id_name.alias("id"), F.col("_row").alias("row"))
    groups = again.groupBy("_key").agg(F.count("*").alias("group_size"), F.min(order).alias("_best"))
    groups = materialise(groups, "dedup-groups")  # so that the join is dealt on its own and a hot key's rows can be split
    grouped = again.join(groups, "_key").select(
        *wanted,
        F.col("_best.id").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("_best.row")).alias("kept"),
        F.col("_key").alias("text_sha256"),
    )
    return unique.unionByName(grouped)


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with their columns."""
    return exact_duplicates(docs, id_col, text_col).filter("kept").drop(*RESULT)
