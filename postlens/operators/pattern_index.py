"""Join of texts with any number of regular expressions: an index of the literals that each pattern must contain.

Literals are read off the patterns, cut to a few dozen lengths and hashed; a text gives the hash of each of its
substrings of such a length, at the edges of words only where the literal stands at one. Texts and literals then meet
in an equality join, whatever their numbers: a pattern whose literal a text does not contain is never tried on it. A
broadcast bitmap of bounded size keeps back nearly all substrings that are no literal. What is left, pairs of a text
and a pattern that may match, is confirmed by Spark's own RLIKE. Patterns that ask for no literal are tried on every
text as literals of a plan, a bounded number at a time.

Neither side has to fit in a task or the driver, and none is broadcast unless Spark finds it small enough.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.patterns import placed_clauses
from postlens.session import discard, free_shuffles, materialise, materialise_by_key

CHUNK, LITERALS = 50_000, 2_000
#: Bytes that literals are cut to; with the edges of words at most four times as many kinds of substrings.
SIZES = np.array([*range(2, 17), 20, 24, 32, 48, 64, 96, 128])
MIN_BITS, MAX_BITS, BITS_EACH = 16, 28, 12  # the bitmap: 2 ** 16 to 2 ** 28 bits (32 MB), 12 a literal if they suffice
SLOTS = (0, 16, 32)  # shifts of a key that give its places in the bitmap
SLICE = 1 << 20  # bytes of text looked at together
LEFT, RIGHT = 1, 2

_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123)]] = True
_random = np.random.default_rng(20_240_501)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = int(_random.integers(1, 1 << 62)) * 2 + 1
_STEP, _BACK = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))


class _Bytes:
    """Bytes of texts, A-Z folded, and hashes of their substrings modulo 2 ** 64."""

    def __init__(self, data: np.ndarray):
        self.data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        powers = np.ones(len(data), dtype=np.uint64)
        powers[1:] = _STEP
        self.back = np.ones(len(data) + 1, dtype=np.uint64)
        self.back[1:] = _BACK
        self.back = np.cumprod(self.back)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[self.data] * np.cumprod(powers), out=self.sums[1:])

    def keys(self, starts: np.ndarray, sizes: np.ndarray | int, edges: np.ndarray | int) -> np.ndarray:
        """Keys of substrings: of their bytes, their size and the edges they have to stand at."""
        kind = np.atleast_1d(np.asarray(sizes, dtype=np.uint64)) * np.uint64(4) + np.asarray(edges, dtype=np.uint64)
        x = (self.sums[starts + sizes] - self.sums[starts]) * self.back[starts] + kind * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def read_literals(patterns: DataFrame) -> DataFrame:
    """(_id, _place, _size, _edges, _key) of all literals of all clauses of patterns (_id, _pattern).

    A literal that is longer than a size loses what lies away from the edge that it stands at.
    """

    def read(batches):
        for batch in batches:
            ids, places, sizes, edges, texts = [], [], [], [], []
            for number, pattern in zip(batch["_id"].to_pylist(), batch["_pattern"].to_pylist()):
                for place, clause in enumerate(placed_clauses(pattern)):
                    for text, left, right in clause:
                        held = text.encode()
                        size = int(SIZES[np.searchsorted(SIZES, len(held), "right") - 1])
                        if size < len(held):
                            held = held[:size] if left and not right else held[-size:]
                            left = left and not right
                        ids.append(number)
                        places.append(place)
                        sizes.append(size)
                        edges.append(LEFT * left + RIGHT * right)
                        texts.append(held)
            long = np.array(sizes, dtype=np.int64)
            data = _Bytes(np.frombuffer(b"".join(texts), dtype=np.uint8))
            keys = data.keys(np.cumsum(long) - long, long, np.array(edges, dtype=np.int64)).view(np.int64)
            columns = [pa.array(ids, pa.int64()), pa.array(places, pa.int32()), pa.array(sizes, pa.int32()), pa.array(edges, pa.int32()), pa.array(keys)]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "_place", "_size", "_edges", "_key"])

    return patterns.select("_id", "_pattern").mapInArrow(read, "_id long, _place int, _size int, _edges int, _key long")


def numbered(patterns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Patterns (`_pattern` and values) with a number (`_id`), and the literals (_id, _size, _edges, _key) to look for;
    both written. A pattern without literals has none.

    Of the clauses that a pattern asks for, the one is taken whose literals fewest patterns share, then the longest: what
    most patterns have in common tells no text apart.
    """
    known = materialise(patterns.withColumn("_id", F.monotonically_increasing_id()), "patterns")
    literals = materialise(read_literals(known), "pattern-literals")
    shared = literals.groupBy("_key").agg(F.count("*").alias("_n"))
    weighed = literals.join(shared, "_key").groupBy("_id", "_place").agg(F.sum("_n").alias("_n"), F.min("_size").alias("_short"))
    best = weighed.groupBy("_id").agg(F.min(F.struct("_n", -F.col("_short"), "_place"))["_place"].alias("_place"))
    return known, materialise(literals.join(best, ["_id", "_place"]).drop("_place"), "pattern-literals")


def bitmap_of(literals: DataFrame, key: str = "_key") -> np.ndarray:
    """Bits set at the slots of all keys, as bytes."""
    bits = min(MAX_BITS, max(MIN_BITS, math.ceil(math.log2(max(1, literals.count()) * BITS_EACH))))
    slots = [F.shiftrightunsigned(key, shift).bitwiseAND(F.lit((1 << bits) - 1)) + 1 for shift in SLOTS]
    slot = literals.select(F.explode(F.array(*slots)).alias("_slot"))
    buckets = slot.groupBy(F.bitmap_bucket_number("_slot").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bitmap")
    )
    out = np.zeros(1 << (bits - 3), dtype=np.uint8)
    for row in buckets.toLocalIterator():
        at = (row["_bucket"] - 1) * len(row["_bitmap"])
        out[at : at + len(row["_bitmap"])] = np.frombuffer(row["_bitmap"], dtype=np.uint8)
    return out


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, offsets, bytes) of the texts of a batch, some megabyte or one text at a time."""
    texts = batch["_text"].cast(pa.large_string())
    rows = batch["_row"].to_numpy(zero_copy_only=False)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < len(rows):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1)
        mine = offsets[at : upto + 1]
        yield rows[at:upto], mine - mine[0], data[mine[0] : mine[-1]]
        at = upto


def _substrings(data: _Bytes, offsets: np.ndarray, kinds: Sequence[tuple[int, int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, key) arrays: for each kind (edges, size) the substrings of that size which stand at those edges."""
    n, is_word = len(data.data), _WORD[data.data]
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    begins, ends = np.zeros(n + 1, dtype=bool), np.zeros(n + 1, dtype=bool)  # where words start and end
    begins[:n] = is_word
    begins[1:n] &= ~is_word[:-1] | (owner[1:] != owner[:-1])
    ends[1:] = is_word
    ends[1:n] &= ~is_word[1:] | (owner[1:] != owner[:-1])
    heads, tails = np.flatnonzero(begins), np.flatnonzero(ends)
    for edges, size in kinds:
        if size > n:
            continue
        if edges & RIGHT:
            starts = tails[tails >= size] - size
            starts = starts[begins[starts]] if edges & LEFT else starts
        else:
            starts = heads[heads <= n - size] if edges & LEFT else np.arange(n - size + 1)
        starts = starts[owner[starts] == owner[starts + size - 1]]
        yield owner[starts], data.keys(starts, size, edges)


def literal_hits(texts: DataFrame, literals: DataFrame) -> DataFrame:
    """(_row, _key) of texts (_row, _text) and the keys of `literals` that they may contain, each once."""
    kinds = sorted((r["_edges"], r["_size"]) for r in literals.select("_edges", "_size").distinct().collect())
    held = texts.sparkSession.sparkContext.broadcast(bitmap_of(literals))

    def find(batches):
        bitmap = held.value
        mask = np.uint64(len(bitmap) * 8 - 1)

        def maybe(keys: np.ndarray) -> np.ndarray:
            """Positions of the keys that the bitmap does not rule out."""
            left = np.arange(len(keys))
            for shift in SLOTS:
                slot = (keys[left] >> np.uint64(shift)) & mask
                left = left[(bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1]
            return left

        for rows, offsets, data in chain.from_iterable(map(_slices, batches)):
            owners, keys = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
            for owner, key in _substrings(_Bytes(data), offsets, kinds):
                left = maybe(key)
                owners.append(owner[left])
                keys.append(key[left])
            owner, key = np.concatenate(owners), np.concatenate(keys)
            order = np.lexsort((key, owner))
            owner, key = owner[order], key[order]
            new = np.ones(len(key), dtype=bool)
            new[1:] = (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])
            columns = [pa.array(rows[owner[new]], pa.int64()), pa.array(key[new].view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["_row", "_key"])

    return texts.filter("_text IS NOT NULL").select("_row", "_text").mapInArrow(find, "_row long, _key long")


def tried_on_all(texts: DataFrame, patterns: DataFrame, literals: int = LITERALS) -> list[DataFrame]:
    """(_row, _id) pairs of texts and patterns (those that ask for no literal) that match, found by trying each."""
    parts, out = math.ceil(patterns.count() / literals), []
    for number in range(parts):
        rows = patterns.filter(F.pmod(F.xxhash64("_id"), F.lit(parts)) == number).select("_id", "_pattern").collect()
        hits = F.array_compact(F.array(*[F.when(F.col("_text").rlike(r["_pattern"]), F.lit(r["_id"])) for r in rows]))
        if rows:
            out.append(materialise(texts.select("_row", F.explode(hits).alias("_id")), "pattern-candidates"))
    return out


def indexed_pattern_join(
    df: DataFrame, text: Column, patterns: DataFrame, names: Sequence[str], chunk: int = CHUNK, literals: int = LITERALS
) -> DataFrame:
    """Left join `text rlike _pattern` with any number of patterns: a row per match, one with NULLs where none matches.

    `patterns` has a column `_pattern` without NULLs and the value columns `names`. Repeated patterns each match.
    `chunk` is without effect: literals of any number are joined at once.
    """
    known, searched = numbered(patterns.select("_pattern", *names))
    held = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_held"), text.alias("_text"), F.monotonically_increasing_id().alias("_row"))
    texts = materialise_by_key(held, "pattern-texts", "_row")
    free_shuffles(df.sparkSession)
    open_ = materialise(known.join(searched.select("_id").distinct(), "_id", "left_anti"), "patterns")
    used = tried_on_all(texts, open_, literals)
    pairs = [found.join(open_.withColumn("_pattern", F.lit(None).cast("string")), "_id") for found in used]
    if not searched.isEmpty():
        asked = materialise(known.join(searched.select("_id", "_key"), "_id"), "pattern-literals")
        used.append(asked)
        pairs.append(literal_hits(texts, searched).join(asked, "_key"))
    if not pairs:
        return df.select(*df.columns, *[F.lit(None).cast(patterns.schema[n].dataType).alias(n) for n in names])
    pairs = [p.select(F.col("_row").alias("_at"), "_id", "_pattern", F.struct(*names).alias("_values")) for p in pairs]
    # Both sides lie in buckets by text, so that neither the removal of repeated pairs nor the join with the texts shuffles
    # whole texts and patterns; what the pairs were found with can go first.
    candidates = materialise_by_key(reduce(DataFrame.unionAll, pairs), "pattern-candidates", "_at")
    discard(*used, known, searched, open_)
    free_shuffles(df.sparkSession)
    candidates = candidates.dropDuplicates(["_at", "_id"])
    matches = F.expr("_row = _at AND (_pattern IS NULL OR _text RLIKE _pattern)")
    return texts.join(candidates, matches, "left").select("_held.*", *[F.col("_values")[n].alias(n) for n in names])
