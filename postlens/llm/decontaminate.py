"""Benchmark decontamination: documents that repeat a passage of a test set, by Wu-Manber multi-pattern search.

The symbols are words, not characters. All windows of one length form one search: a shift table over blocks of two
words says how far the search may jump, a block that ends a window leads to a bucket of windows by its hash, a second
hash (the window's first block) narrows the bucket, and a direct comparison confirms the occurrence.

The windows are broadcast in blocks of at most `block_bytes` of test text, measured before anything is collected.
Documents are never shuffled: every block of windows is one more pass over them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.frames import slices, utf8, without
from postlens.session import materialise

WINDOW = 10
BLOCK_BYTES = 32 << 20
PIECE_WORDS = 4096
RESULT = ("n_words", "n_hit", "items", "hit_spans", "contaminated")

#: Word characters: digits, letters a to z, everything beyond ASCII; A-Z are folded, the rest of ASCII separates.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class WindowSearch:
    """All windows of one length, ready to be searched for in lists of words."""

    def __init__(self, windows: dict[tuple[bytes, ...], set[str]]):
        self.length = len(next(iter(windows)))
        self.block = min(2, self.length)
        self.longest_shift = self.length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = defaultdict(lambda: defaultdict(list))
        for window, items in windows.items():
            for end in range(self.block, self.length + 1):
                key = window[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.longest_shift), self.length - end)
            self.buckets[window[-self.block :]][window[: self.block]].append((list(window), sorted(items)))

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        """Start of each occurrence and the items it belongs to."""
        length, block, shift, longest = self.length, self.block, self.shift.get, self.longest_shift
        end, total = length, len(words)
        while end <= total:
            key = tuple(words[end - block : end])
            jump = shift(key, longest)
            if jump:
                end += jump
                continue
            start = end - length
            for window, items in self.buckets[key].get(tuple(words[start : start + block]), ()):
                if words[start:end] == window:
                    yield start, items
            end += 1


def searches_of(pieces: list[tuple[str, list[bytes], bool]], window: int) -> list[WindowSearch]:
    """Searches for the windows of (item, words, whether the words are the whole item), one for each length."""
    by_length: dict[int, dict] = defaultdict(dict)
    for item, words, whole in pieces:
        if whole and 0 < len(words) < window:
            by_length[len(words)].setdefault(tuple(words), set()).add(item)
        for at in range(len(words) - window + 1):
            by_length[window].setdefault(tuple(words[at : at + window]), set()).add(item)
    return [WindowSearch(w) for _, w in sorted(by_length.items())]


def hits_of(words: list[bytes], searches: list[WindowSearch]) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged [start, end) word spans covered by occurrences, and the items that occur."""
    found, items = [], set()
    for search in searches:
        for start, names in search.find(words):
            found.append((start, start + search.length))
            items.update(names)
    return merged(found), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _test_pieces(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(item, words, whole): item texts as folded words, long ones cut into overlapping pieces that hold every window."""
    rows = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"), utf8(F.col(f"`{text_col}`")).alias("text"))

    def cut(batches):
        for batch in batches:
            out = []
            for item, text in zip(batch["item"].to_pylist(), batch["text"].to_pylist()):
                words = words_of(text)
                for at in range(0, max(1, len(words) - window + 1), PIECE_WORDS):
                    piece = words[at : at + PIECE_WORDS + window - 1]
                    out.append((item, b" ".join(piece), len(piece) == len(words)))
            names = ["item", "words", "whole"]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(names, r)) for r in out],
                schema=pa.schema([("item", pa.string()), ("words", pa.binary()), ("whole", pa.bool_())]),
            )

    return rows.filter("item IS NOT NULL AND text IS NOT NULL").mapInArrow(cut, "item string, words binary, whole boolean")


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """`docs` with their words covered by windows of the benchmark.

    Adds `n_words`, `n_hit` (words inside an occurrence), `items` (ids with an occurring window, as strings in string
    order), `hit_spans` (start and end word of each covered stretch) and `contaminated`. A window is `window`
    consecutive words of an item; an item of fewer words is one window. NULL or wordless texts and items have no
    words and match nothing, items without an id are left out, rows of one id count as one item, repeated documents
    are each reported, and an empty benchmark marks nothing. Columns that clash with a result column are replaced;
    `carry` names the columns to return besides (default: all).
    """
    spark = docs.sparkSession
    pieces = _test_pieces(benchmark, item_col, item_text_col, window).distinct()
    size = pieces.agg(F.sum(F.length("words") + F.length("item"))).first()[0] or 0
    blocks = int(size // block_bytes) + 1
    block_of = F.pmod(F.xxhash64("item", "words"), F.lit(blocks))
    base = without(docs, RESULT)
    kept = [c for c in base.columns if carry is None or c in carry]
    out = base.select(
        *[F.col(f"`{c}`") for c in dict.fromkeys([*kept, text_col])],
        F.lit(0).cast("bigint").alias("n_words"),
        F.lit(None).cast("array<string>").alias("items"),
        F.lit(None).cast("array<struct<start:int,end:int>>").alias("hit_spans"),
    )
    for block in range(blocks):
        rows = pieces.filter(block_of == block).collect()  # about block_bytes at most, as measured
        held = spark.sparkContext.broadcast([(r.item, bytes(r.words).split(b" ") if r.words else [], r.whole) for r in rows])
        last = block + 1 == blocks
        names = [*kept, "n_words", "items", "hit_spans"] if last else out.columns
        out = out.mapInArrow(_scan(held, window, text_col, names), out.select(*[F.col(f"`{c}`") for c in names]).schema)
        out = out if last else materialise(out, "decontaminate")
    covered = F.aggregate("hit_spans", F.lit(0).cast("bigint"), lambda total, span: total + span["end"] - span["start"])
    return out.select(
        *[F.col(f"`{c}`") for c in kept],
        "n_words",
        covered.alias("n_hit"),
        "items",
        "hit_spans",
        (F.size("hit_spans") > 0).alias("contaminated"),
    )


def _scan(held, window: int, text_col: str, names: list[str]):
    def scan(batches):
        searches = searches_of(held.value, window)
        for batch in slices(batches, text_col):
            counts, items, spans = [], [], []
            texts = batch[text_col].cast(pa.binary())
            for text, before, covered in zip(texts, batch["items"].to_pylist(), batch["hit_spans"].to_pylist()):
                words = words_of(text.as_py())
                found, hit = hits_of(words, searches)
                found = merged(found + [(s["start"], s["end"]) for s in covered or ()])
                counts.append(len(words))
                items.append(sorted(hit.union(before or ())))
                spans.append([{"start": a, "end": b} for a, b in found])
            new = {
                "n_words": pa.array(counts, pa.int64()),
                "items": pa.array(items, pa.list_(pa.string())),
                "hit_spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            }
            yield pa.RecordBatch.from_arrays([new[n] if n in new else batch[n] for n in names], names=names)

    return scan


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any passage of the benchmark, with their columns (those that clash with a result column go)."""
    return find_contamination(docs, benchmark, **options).filter("NOT contaminated").drop(*RESULT)

