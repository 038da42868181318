"""Substring deduplication by anchored blocks and window counts, standing in for a relative Lempel-Ziv parse.

No greedy longest match is sought and factors have no source position: what goes is every window that occurs twice
anywhere, which counts of equal blocks and windows tell without a source, in partial sums; a parse would have to choose
one source among many and extend it word by word across tasks. Neighbouring repeated blocks may have different sources.

The reference is every document, cut into blocks. A block is a stretch of words whose windows of `window` words share
an anchor, their smallest run of `GRAM` words (the leftmost, compared by hash), so equal windows always lie in blocks
with equal anchors, wherever they are. The index counts the blocks of each anchor; Spark shuffles one row a block.

A document is cut into factors: neighbouring blocks that occur elsewhere as a whole form one factor, and
every window inside is repeated. Where a factor ends in a block that shares its anchor with others but is not equal to
any, the repeated text may go on for some windows: those boundaries are checked window by window, by hash, against
the blocks of the same anchor (each distinct block once, however often it occurs).

Nothing is compared pairwise; anchors, blocks and windows are counted with partial sums, so a passage that a third
of all documents share stays a few counters. Blocks and windows are told apart by two 64-bit hashes each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from itertools import compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.frames import slices, without
from postlens.llm.words import mix, range_hashes, run_hashes, split_words
from postlens.session import materialise

WINDOW, GRAM = 35, 6
RESULT = ("n_words", "n_removed", "spans", "kept")
_SPANS = T.ArrayType(T.StructType().add("start", "integer").add("end", "integer"))
_SPAN_KIND = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


class Blocks(NamedTuple):
    """Blocks of a batch of texts: windows `first` to `last` (positions in the batch), their text, anchor and hash."""

    first: np.ndarray
    last: np.ndarray
    owner: np.ndarray
    anchor: np.ndarray
    block: np.ndarray


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest (leftmost) of each `width` consecutive values."""
    best, at, span = values, np.arange(len(values)), 1
    while span < width:
        jump = min(span, width - span)
        right = best[jump:] < best[:-jump]
        at = np.where(right, at[jump:], at[:-jump])
        best = np.where(right, best[jump:], best[:-jump])
        span += jump
    return at


def blocks_of(hashes: np.ndarray, owner: np.ndarray, window: int) -> Blocks:
    none = np.zeros(0, dtype=np.int64)
    if len(hashes) < window:
        return Blocks(none, none, none, none, none)
    gram = min(GRAM, window)
    grams = run_hashes(hashes, gram)
    at = _smallest(grams, window - gram + 1)
    whole = np.flatnonzero(owner[: len(at)] == owner[window - 1 :])
    if not len(whole):
        return Blocks(none, none, none, none, none)
    places = at[whole]
    begins = np.ones(len(whole), dtype=bool)
    begins[1:] = (places[1:] != places[:-1]) | (owner[whole][1:] != owner[whole][:-1])
    first = whole[begins]
    last = whole[np.append(np.flatnonzero(begins)[1:], len(whole)) - 1]
    anchor = grams[places[begins]].view(np.int64)
    block = range_hashes(hashes, first, last + window).view(np.int64)
    return Blocks(first, last, owner[first], anchor, block)


def merge_spans(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _kept(text: bytes, spans: Sequence[tuple[int, int]], digest: bool) -> str:
    words = text.split()
    if spans:
        keep = np.ones(len(words), dtype=bool)
        for start, end in spans:
            keep[start:end] = False
        words = list(compress(words, keep.tolist()))
    joined = b" ".join(words)
    return hashlib.sha256(joined).hexdigest() if digest else joined.decode("utf-8", "replace")


def _block_key(anchor: np.ndarray, block: np.ndarray) -> np.ndarray:
    return mix(anchor.view(np.uint64) ^ mix(block.view(np.uint64)))


def block_rows(docs: DataFrame, text_col: str, window: int) -> DataFrame:
    """(doc, anchor, block): every block of every document."""

    def parse(batches):
        for batch in slices(batches, text_col):
            words = split_words(batch[text_col], lower=False)
            found = blocks_of(words.hashes, words.owner(), window)
            doc = batch["_doc"].to_numpy(zero_copy_only=False)[found.owner]
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(found.anchor), pa.array(found.block)], names=["doc", "anchor", "block"])

    return docs.select("_doc", F.col(f"`{text_col}`")).mapInArrow(parse, "doc long, anchor long, block long")


def block_verdicts(rows: DataFrame) -> DataFrame:
    """(doc, blocks): of each document the blocks that share an anchor, as (anchor, block, repeated, check).

    `repeated` blocks occur at least twice as a whole. `check` asks a document for the windows of a block: of blocks
    that occur once, and of one document each for the other blocks of their anchors.
    """
    shared = rows.groupBy("anchor").count().filter("count > 1").select("anchor")
    again = materialise(rows.join(shared, "anchor"), "substring-again")
    kinds = again.groupBy("anchor", "block").agg(F.count("*").alias("n"), F.min("doc").alias("source"))
    anchors = kinds.groupBy("anchor").agg(((F.min("n") == 1) & (F.count("*") > 1)).alias("open"))
    known = materialise(kinds.join(anchors, "anchor"), "substring-kinds")
    each = again.join(known, ["anchor", "block"]).select(
        "doc", F.struct("anchor", "block", (F.col("n") > 1).alias("repeated"), (F.col("open") & (F.col("source") == F.col("doc"))).alias("check")).alias("b")
    )
    return each.groupBy("doc").agg(F.collect_set("b").alias("blocks"))


def remove_repeats(
    docs: DataFrame,
    text_col: str = "text",
    window: int = WINDOW,
    carry: Sequence[str] | None = None,
    digest: bool = False,
) -> DataFrame:
    """`docs` with the words that are left when every repeated window of words is removed.

    A window is `window` consecutive words (between white space, unchanged) of one document; it is repeated if the
    same words also start anywhere else, the same document included, and all its occurrences go. Adds `n_words`,
    `n_removed`, `spans` (start and end word of what goes) and `kept`: the words left, joined by one space, or with
    `digest` the SHA-256 of that. NULL, empty and short texts lose nothing; of repeated rows every one loses all
    windows. An empty table stays empty. Columns that clash with a result column are replaced; `carry` names the
    columns to return besides (default: all).
    """
    base = without(docs, RESULT)
    names = [c for c in base.columns if carry is None or c in carry]
    keyed = base.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*names, text_col])]).withColumn("_doc", F.xxhash64(F.col(f"`{text_col}`")))
    rows = materialise(block_rows(keyed, text_col, window), "substring-blocks")
    verdicts = block_verdicts(rows).withColumnRenamed("doc", "_doc").withColumnRenamed("blocks", "_blocks")
    carried = [F.col(f"`{c}`") for c in names]
    schema = keyed.select(*carried).schema.add("n_words", "long").add("spans", _SPANS).add("kept", "string").add("_text", "binary")
    schema = schema.add("_checks", T.ArrayType(T.StructType().add("anchor", "long").add("window", "long").add("at", "integer").add("open", "boolean")))
    parsed = materialise(
        keyed.join(verdicts, "_doc", "left")
        .mapInArrow(_parse_into_factors(text_col, window, names, digest), schema)
        .withColumn("_row", F.monotonically_increasing_id()),
        "substring-factors",
    )
    checks = parsed.select("_row", F.inline("_checks"))
    twice = checks.groupBy("anchor", "window").count().filter("count > 1").select("anchor", "window")
    found = checks.filter("open").join(twice, ["anchor", "window"]).groupBy("_row").agg(F.collect_list("at").alias("_at"))
    final = keyed.select(*carried).schema.add("n_words", "long").add("spans", _SPANS).add("kept", "string")
    whole = parsed.drop("_checks").join(found, "_row", "left").mapInArrow(_finish(window, names, digest), final)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, span: total + span["end"] - span["start"])
    return whole.select(*carried, "n_words", removed.alias("n_removed"), "spans", "kept")


def _parse_into_factors(text_col: str, window: int, names: list[str], digest: bool):
    """Marks the factors of each document; a document with boundaries to check keeps its text for `_finish`."""

    def parse(batches):
        for batch in slices(batches, text_col):
            rows = batch.num_rows
            texts = batch[text_col].cast(pa.binary())
            words = split_words(texts, lower=False)
            counts = words.counts()
            given = batch["_blocks"].combine_chunks() if isinstance(batch["_blocks"], pa.ChunkedArray) else batch["_blocks"]
            flat = given.flatten()
            spans: list[list[tuple[int, int]]] = [[] for _ in range(rows)]
            checks: list[list[dict]] = [[] for _ in range(rows)]
            open_rows: set[int] = set()
            if len(flat):
                column = lambda name: flat.field(name).to_numpy(zero_copy_only=False)  # noqa: B023, E731
                known = _block_key(column("anchor"), column("block"))
                order = np.argsort(known, kind="stable")
                repeated, check = column("repeated")[order], column("check")[order]
                known, firsts = np.unique(known[order], return_index=True)
                asked = np.logical_or.reduceat(check, firsts)
                repeated = repeated[firsts]
                own = blocks_of(words.hashes, words.owner(), window)
                keys = _block_key(own.anchor, own.block)
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = known[at] == keys
                for i in np.flatnonzero(hit & repeated[at]).tolist():
                    text = int(own.owner[i])
                    base = int(words.first[text])
                    spans[text].append((int(own.first[i]) - base, int(own.last[i]) + window - base))
                windows = run_hashes(words.hashes, window).view(np.int64)
                for i in np.flatnonzero(hit & asked[at]).tolist():
                    text, is_open = int(own.owner[i]), not repeated[at[i]]
                    base, anchor = int(words.first[text]), int(own.anchor[i])
                    if is_open:
                        open_rows.add(text)
                    checks[text] += [
                        {"anchor": anchor, "window": int(windows[w]), "at": w - base, "open": is_open}
                        for w in range(int(own.first[i]), int(own.last[i]) + 1)
                    ]
            spans = [merge_spans(s) for s in spans]
            raw = [t.as_py() or b"" for t in texts]
            kept = [None if i in open_rows else _kept(raw[i], spans[i], digest) for i in range(rows)]
            arrays = [batch[c] for c in names] + [
                pa.array(counts, pa.int64()),
                pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], _SPAN_KIND),
                pa.array(kept, pa.string()),
                pa.array([raw[i] if i in open_rows else None for i in range(rows)], pa.binary()),
                pa.array(checks, pa.list_(pa.struct([("anchor", pa.int64()), ("window", pa.int64()), ("at", pa.int32()), ("open", pa.bool_())]))),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "n_words", "spans", "kept", "_text", "_checks"])

    return parse


def _finish(window: int, names: list[str], digest: bool):
    """Adds the windows that the checks found repeated to the factors of the documents they were asked of."""

    def finish(batches):
        for batch in batches:
            spans, kept = batch["spans"].to_pylist(), batch["kept"].to_pylist()
            for i, (text, at) in enumerate(zip(batch["_text"].to_pylist(), batch["_at"].to_pylist())):
                if text is not None:
                    merged = merge_spans([(s["start"], s["end"]) for s in spans[i]] + [(a, a + window) for a in at or ()])
                    spans[i] = [{"start": a, "end": b} for a, b in merged]
                    kept[i] = _kept(text, merged, digest)
            arrays = [batch[c] for c in names] + [batch["n_words"], pa.array(spans, _SPAN_KIND), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "n_words", "spans", "kept"])

    return finish
