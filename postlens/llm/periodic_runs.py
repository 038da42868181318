"""Periodic runs of words: stretches that repeat a period at least four times, found on tiles scaled to the period.

Periods are dealt into octaves [s, 2 s). A run of a period q in the octave of s has at least 3 q pairs of equal words
q apart, so with boundaries at all multiples of s one boundary lies less than s words after its start and is followed
by s equal pairs. A tile is what surrounds a boundary: s words before it and 4 s after it. Tiles overlap by more than
a period, so what neighbouring tiles find of one run overlaps too.

A boundary is looked at only if the s words after it come again q words later, which one comparison of fingerprints
for each word and octave tells for all q at once. Then the Z-function of the words after the boundary gives, for every
period, how far the repetition goes to the right, and the Z-function of the reversed words before it how far to the
left. Periods that are multiples of a smaller one are dropped: the smaller one has the same run. What ends inside a
tile at both sides and is too short is dropped; all else is a fragment (document, period, start, end).

Documents of up to `TILE` words are one tile with all octaves, so nothing of them has to meet and they are solved where
they lie. Longer ones are exploded into tiles per octave (the small octaves share a tile, larger ones get tiles of their
size), which Spark deals out, so that no task solves a whole long document. A tile joins the fragments of its own
boundaries; they are shuffled by document and period, where those of neighbouring tiles are stitched to runs. Only long
documents meet their text again. Words are told apart by 64-bit hashes; each fingerprint that matches is confirmed by
the Z-functions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.frames import slices, utf8, without
from postlens.llm.words import mix, split_words
from postlens.session import materialise

PERIODS, LEAST = 4, 6
TILE = 1 << 13
RESULT = ("n_words", "runs", "collapsed")
_WORK = ("_row", "_text")
_RUNS = T.ArrayType(T.StructType().add("start", "long").add("period", "long").add("length", "long"))
_RUN_KIND = pa.list_(pa.struct([("start", pa.int64()), ("period", pa.int64()), ("length", pa.int64())]))
_STEP = np.uint64(0xD1342543DE82EF95)


class Tiles(NamedTuple):
    """Tiles over one array of word hashes: tile t holds `hashes[first[t]:first[t + 1]]`, the words from `low[t]` on of
    a document of `size[t]` words, and answers for the boundaries from `core[t]` to `stop[t]` in octaves from `octave[t]`
    below `above[t]`."""

    hashes: np.ndarray
    first: np.ndarray
    low: np.ndarray
    size: np.ndarray
    core: np.ndarray
    stop: np.ndarray
    octave: np.ndarray
    above: np.ndarray


def octaves(words: int) -> int:
    """Number of octaves [s, 2 s) of which a document of so many words can hold a run (4 s words at least)."""
    return max(0, words // PERIODS).bit_length()


def z_function(words: list) -> list[int]:
    """Length of the longest common prefix of the list and of each of its suffixes."""
    n = len(words)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and words[k] == words[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


@lru_cache(maxsize=4096)
def _prime_divisors(q: int) -> tuple[int, ...]:
    out, p = [], 2
    while p * p <= q:
        if q % p == 0:
            out.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return (*out, q) if q > 1 else tuple(out)


def _around(words: list, before: int, step: int, periods: Sequence[int], opens: bool, ends: bool) -> Iterator[tuple[int, int, int]]:
    """(period, start, end), relative to the boundary after `before` words, of what repeats there.

    `opens` and `ends` tell whether the tile begins and ends with the document.
    """
    after = words[before:]
    right = z_function(after)
    known = words[:before][::-1]
    reach = min(2 * step, len(after))
    # The separator is no word, so no common prefix goes past the words before the boundary.
    left = z_function([*known, None, *words[: before + reach][::-1]])[before + 1 :] if before else None
    for q in periods:
        pairs = right[q]
        if pairs < step or any(right[q // p] >= q - q // p for p in _prime_divisors(q)):
            continue
        back = left[reach - q] if left is not None else 0
        closed = (back < before or opens) and (q + pairs < len(after) or ends)
        if not closed or back + pairs + q >= max(LEAST, PERIODS * q):
            yield q, -back, q + pairs


def solve(tiles: Tiles) -> tuple[np.ndarray, np.ndarray]:
    """The fragments of all tiles as rows (period, start, end) in document positions, and the tile of each."""
    number = np.arange(len(tiles.low))
    first, hashes = tiles.first, tiles.hashes
    counts = np.diff(first)
    marks = hashes.copy()  # fingerprints of `step` words from each position on, grown by doubling
    words = hashes
    found: list[tuple[int, int, int]] = []
    owner: list[int] = []
    for k in range(int(tiles.above.max(initial=0))):
        step = 1 << k
        keep = (tiles.above[number] > k) & (tiles.size[number] >= max(LEAST, PERIODS * step))
        if not keep.all():
            inside = np.repeat(keep, counts)
            words, marks, number, counts = words[inside], marks[inside], number[keep], counts[keep]
            first = np.concatenate([[0], np.cumsum(counts)])
        if not len(number):
            break
        at = np.arange(len(words)) - np.repeat(first[:-1] - tiles.low[number], counts)  # position in the document
        phase = at & (step - 1)
        boundary = at - phase - step
        own = (boundary >= np.repeat(tiles.core[number], counts)) & (boundary < np.repeat(tiles.stop[number], counts))
        own &= at + step <= np.repeat(tiles.low[number] + counts, counts)
        own &= np.repeat(tiles.octave[number] <= k, counts)
        places = np.flatnonzero(own)
        anchors = places - phase[places] - step
        same = marks[places] == marks[anchors]
        places, anchors = places[same], anchors[same]
        if len(places):
            begins = np.flatnonzero(np.diff(anchors, prepend=-1))
            latest: dict[tuple[int, int], int] = {}  # of a tile and period, the last fragment
            for i, j in zip(begins.tolist(), [*begins[1:].tolist(), len(anchors)]):
                anchor = int(anchors[i])
                tile = int(np.searchsorted(first, anchor, "right")) - 1
                begin, stop = max(int(first[tile]), anchor - step), min(int(first[tile + 1]), anchor + 4 * step)
                low = int(tiles.low[number[tile]])
                document = begin - int(first[tile]) + low, stop - int(first[tile]) + low
                place = anchor - int(first[tile]) + low
                lags = (places[i:j] - anchor).tolist()
                size = int(tiles.size[number[tile]])
                for q, start, end in _around(words[begin:stop].tolist(), anchor - begin, step, lags, document[0] == 0, document[1] == size):
                    last = latest.get((tile, q))
                    if last is not None and place + start <= found[last][2] - q:
                        found[last] = (q, found[last][1], max(found[last][2], place + end))
                        continue
                    latest[tile, q] = len(found)
                    found.append((q, place + start, place + end))
                    owner.append(int(number[tile]))
        grown = np.zeros_like(marks)
        if step < len(marks):
            grown[:-step] = mix(marks[:-step] * _STEP + marks[step:])
        marks = grown
    return np.array(found, dtype=np.int64).reshape(-1, 3), np.array(owner, dtype=np.int64)


def whole_documents(hashes: np.ndarray, first: np.ndarray) -> Tiles:
    """Each document as one tile that answers for all of its boundaries."""
    sizes = np.diff(first)
    none = np.zeros(len(sizes), dtype=np.int64)
    above = np.array([octaves(n) for n in sizes.tolist()], dtype=np.int64)
    return Tiles(hashes, first, none, sizes, none, sizes, none, above)


def tile_bounds(words: int, tile: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(low, high, core, stop, octave, above) of the tiles of a document of so many words.

    The octaves whose own tiles would be small share tiles of `tile` boundaries' words; the others have tiles of eight
    steps. Each tile holds a step before its boundaries and four after the last of them.
    """
    shared = min(octaves(words), max(1, octaves(tile // 4)))
    spans = [(0, shared, max(tile, 1 << shared))] + [(k, k + 1, 8 << k) for k in range(shared, octaves(words))]
    for octave, above, span in spans if shared else ():
        step = 1 << (above - 1)
        span -= span % step
        for core in range(0, words, span):
            stop = min(words, core + span)
            yield max(0, core - step), min(words, stop + 3 * step), core, stop, octave, above


def _whole_runs(found: np.ndarray, owner: np.ndarray, count: int) -> list[list[tuple[int, int, int]]]:
    """(start, period, length), in order, of the runs of each document that is one tile: its fragments are whole."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(count)]
    for document, (q, start, end) in zip(owner.tolist(), found.tolist()):
        if end - start >= max(LEAST, PERIODS * q):
            out[document].append((start, q, end - start))
    return [sorted(runs) for runs in out]


def _collapsed(text: bytes | None, runs: Sequence[tuple[int, int, int]], digest: bool) -> str:
    """The words that no run repeats, joined by one space, or their SHA-256."""
    words = (text or b"").split()
    if runs:
        keep = np.ones(len(words), dtype=bool)
        for start, period, length in runs:
            keep[start + period : start + length] = False
        words = list(compress(words, keep.tolist()))
    line = b" ".join(words)
    return hashlib.sha256(line).hexdigest() if digest else line.decode("utf-8", "replace")


def _run_lists(runs: list) -> pa.Array:
    return pa.array([None if r is None else [dict(zip(("start", "period", "length"), x)) for x in r] for r in runs], _RUN_KIND)


def surveyed(rows: DataFrame, carry: Sequence[str], tile: int, digest: bool) -> DataFrame:
    """Rows with their words counted, and with the runs and collapsed words of all but long texts, which stay as `_text`."""
    schema = rows.select(*[F.col(f"`{c}`") for c in carry], "_row").schema
    schema = schema.add("n_words", "long").add("runs", _RUNS).add("collapsed", "string").add("_text", "binary")

    def survey(batches):
        for batch in slices(batches, "_text"):
            words = split_words(batch["_text"], lower=False)
            counts = words.counts()
            long = (counts > tile).tolist()
            inside = words.hashes[np.repeat(counts <= tile, counts)]
            first = np.concatenate([[0], np.cumsum(np.where(counts > tile, 0, counts))])
            runs = _whole_runs(*solve(whole_documents(inside, first)), len(counts))
            texts = batch["_text"].to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch[c] for c in (*carry, "_row")],
                    pa.array(counts.astype(np.int64)),
                    _run_lists([None if again else r for r, again in zip(runs, long)]),
                    pa.array([None if again else _collapsed(t, r, digest) for t, r, again in zip(texts, runs, long)], pa.string()),
                    pa.array([t if again else None for t, again in zip(texts, long)], pa.binary()),
                ],
                names=[*carry, "_row", "n_words", "runs", "collapsed", "_text"],
            )

    return rows.mapInArrow(survey, schema)


def tiles_of(long: DataFrame, tile: int) -> DataFrame:
    """(_row, words, low, size, core, stop, octave, above): the tiles of long texts, `words` as 64-bit hashes."""

    def explode(batches):
        names = ["_row", "words", "low", "size", "core", "stop", "octave", "above"]
        for batch in slices(batches, "_text", 1):
            words = split_words(batch["_text"], lower=False)
            row, size = batch["_row"][0].as_py(), len(words.hashes)
            for low, high, *bounds in tile_bounds(size, tile):
                values = [row, words.hashes[low:high].tobytes(), low, size, *bounds]
                yield pa.RecordBatch.from_pydict({n: [v] for n, v in zip(names, values)})

    schema = "_row long, words binary, low long, size long, core long, stop long, octave long, above long"
    return long.select("_row", "_text").mapInArrow(explode, schema)


def tile_fragments(tiles: DataFrame) -> DataFrame:
    """(_row, period, start, end) of what each tile finds."""

    def find(batches):
        for batch in slices(batches, "words"):
            hashes = [np.frombuffer(w, dtype=np.uint64) for w in batch["words"].to_pylist()]
            first = np.concatenate([[0], np.cumsum([len(h) for h in hashes])]).astype(np.int64)
            bounds = [batch[c].to_numpy() for c in ("low", "size", "core", "stop", "octave", "above")]
            found, owner = solve(Tiles(np.concatenate([*hashes, np.zeros(0, np.uint64)]), first, *bounds))
            columns = [batch["_row"].take(pa.array(owner)), *[pa.array(found[:, i]) for i in range(3)]]
            yield pa.RecordBatch.from_arrays(columns, names=["_row", "period", "start", "end"])

    return tiles.mapInArrow(find, "_row long, period long, start long, end long")


def stitched(fragments: DataFrame) -> DataFrame:
    """(_row, start, period, length) of the runs that fragments make up: those that share or touch equal pairs are one."""
    ordered = Window.partitionBy("_row", "period").orderBy("start", "end")
    earlier = F.max(F.col("end") - F.col("period")).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opening = fragments.withColumn("_opens", F.coalesce(F.col("start") > earlier, F.lit(True)).cast("int"))
    islands = opening.withColumn("_island", F.sum("_opens").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    runs = islands.groupBy("_row", "period", "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start")
    return runs.select("_row", "start", "period", length.alias("length")).filter(length >= F.greatest(F.lit(LEAST), PERIODS * F.col("period")))


def periodic_runs(
    docs: DataFrame, text: Column | str = "text", carry: Sequence[str] | None = None, tile: int = TILE, digest: bool = False
) -> DataFrame:
    """Every row of `docs` with its periodic runs of words.

    Words are stretches without white space `[\\x20\\x09-\\x0D]`, told apart by case, numbered from 0. A run is a stretch
    with smallest period q of at least max(6, 4 q) words that cannot be extended. Adds `n_words`, `runs` (start, period,
    length; by start, then period) and `collapsed`: the words joined by one space without those that a run repeats (all
    but the first q of each run), or its SHA-256 if `digest`. NULL and wordless texts have no runs and collapse to ''.
    Repeated rows each get their result, an empty table none. `carry` names the columns to return (default: all);
    columns that clash with a result column are replaced. `tile` (words of a tile) changes no result.
    """
    text = F.col(f"`{text}`") if isinstance(text, str) else text
    names = [c for c in without(docs, RESULT + _WORK).columns if carry is None or c in carry]
    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.monotonically_increasing_id().alias("_row"), utf8(text).alias("_text"))
    survey = materialise(surveyed(rows, names, tile, digest), "runs-survey")
    long = survey.filter("_text IS NOT NULL").drop("runs", "collapsed")
    tiles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fragments = tile_fragments(tiles_of(long, tile).repartition(tiles, "_row", "octave", "core"))
    runs = stitched(fragments).groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    again = long.join(materialise(runs, "runs"), "_row", "left").withColumn("runs", F.coalesce("runs", F.array().cast(_RUNS)))
    result = [*names, "n_words", "runs", "collapsed"]
    again = again.select(*[F.col(f"`{c}`") for c in names], "n_words", "runs", "_text")

    def collapse(batches):
        for batch in slices(batches, "_text"):
            runs_of = [[(r["start"], r["period"], r["length"]) for r in found] for found in batch["runs"].to_pylist()]
            out = [_collapsed(t, r, digest) for t, r in zip(batch["_text"].to_pylist(), runs_of)]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in result[:-1]], pa.array(out, pa.string())], names=result)

    whole = survey.filter("_text IS NULL").select(*[F.col(f"`{c}`") for c in result])
    return whole.unionByName(again.mapInArrow(collapse, again.drop("_text").schema.add("collapsed", "string")))
