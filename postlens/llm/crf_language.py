"""Language identification with a linear-chain conditional random field over words.

Every word of a text gets a label, so text that switches languages is read piece by piece. Features of a word are its
byte n-grams with boundary marks (those with a mark are its affixes), the word itself, and the language whose lexicon
lists it; transitions between labels are learned too. Marginals come from forward-backward over chains of up to
`CHAIN` words; a document's language is the one with the largest expected share of its words.

The field is trained on the driver, on a sample of bounded size: `docs_per_label` distinct texts of each label, chosen
by hash, of each a stretch of `PIECE` characters at a hashed place. Sequences that switch languages are made of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.frames import slices, utf8, without
from postlens.llm.words import Words, mix, split_words

DOCS_PER_LABEL, PIECE = 1000, 600
GRAMS, BUCKET_BITS, CHAIN = 5, 18, 64
SEQUENCES, LENGTH, EPOCHS, BATCH, RATE = 3000, 48, 4, 50, 0.1
LEXICON_COUNT, LEXICON_SHARE = 3, 0.9
UNDETERMINED = "und"
RESULT = ("lang_pred", "score")

#: Everything in ASCII but letters separates words.
_NOT_LETTER = np.ones(256, dtype=bool)
_NOT_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


class Types(NamedTuple):
    """Distinct words of a batch: hash, hashed n-grams (of all words, one after the other) and where a word's begin."""

    hashes: np.ndarray
    grams: np.ndarray
    begins: np.ndarray
    is_word: np.ndarray


def distinct_words(words: Words) -> tuple[Types, np.ndarray]:
    """The distinct words of a batch, and for each word its number among them."""
    hashes, first, number = np.unique(words.hashes, return_index=True, return_inverse=True)
    starts, ends = words.starts[first], words.ends[first]
    sizes = ends - starts + 2
    stops = np.cumsum(sizes)
    total = int(stops[-1]) if len(stops) else 0
    marked = np.append(words.data, np.uint8(0))[np.minimum(np.arange(total) + np.repeat(starts - 1 - stops + sizes, sizes), len(words.data))]
    marked[stops - sizes], marked[stops - 1] = 0x02, 0x03
    left = np.repeat(stops, sizes) - np.arange(total)  # symbols up to the word's end
    grams, owners = [], []
    owner = np.repeat(np.arange(len(sizes)), sizes)
    packed = np.zeros(total, dtype=np.uint64)
    for n in range(1, GRAMS + 1):
        packed[: total - n + 1] |= marked[n - 1 :].astype(np.uint64) << np.uint64(8 * (n - 1)) if total >= n else 0
        fits = left >= n
        grams.append((mix(packed[fits] * np.uint64(8) + np.uint64(n)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
        owners.append(owner[fits])
    grams.append((mix(hashes) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
    owners.append(np.arange(len(hashes)))
    owners, grams = np.concatenate(owners), np.concatenate(grams)
    order = np.argsort(owners, kind="stable")
    plain = np.zeros(len(words.data) + 1, dtype=np.int64)
    np.cumsum(words.data < 0x80, out=plain[1:])
    is_word = plain[ends] > plain[starts]  # an ASCII letter; otherwise look for a letter beyond ASCII
    for i in np.flatnonzero(~is_word):
        is_word[i] = any(map(str.isalpha, bytes(words.data[starts[i] : ends[i]]).decode("utf-8", "ignore")))
    return Types(hashes, grams[order], np.searchsorted(owners[order], np.arange(len(hashes))), is_word), number


class Field(NamedTuple):
    """Labels, weights of the hashed features, of the lexicon (sorted hashes and their label) and of transitions."""

    labels: list[str]
    weights: np.ndarray
    lexicon: np.ndarray
    lexicon_label: np.ndarray
    lexicon_weights: np.ndarray
    transitions: np.ndarray

    def listed(self, hashes: np.ndarray) -> np.ndarray:
        """Label whose lexicon lists each word; the number of labels where none does."""
        if not len(self.lexicon):
            return np.full(len(hashes), len(self.labels))
        at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == hashes, self.lexicon_label[at], len(self.labels))

    def emissions(self, types: Types) -> np.ndarray:
        if not len(types.hashes):
            return np.zeros((0, len(self.labels)))
        return np.add.reduceat(self.weights[types.grams], types.begins, axis=0) + self.lexicon_weights[self.listed(types.hashes)]


def forward_backward(emissions: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of chains (chain, place, label) of these lengths, and the expected counts of transitions."""
    chains, places, labels = emissions.shape
    step = np.exp(transitions)
    local = np.exp(emissions - emissions.max(axis=2, keepdims=True))
    ahead = np.empty_like(local)
    behind = np.ones_like(local)
    ahead[:, 0] = local[:, 0] / local[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, places):
        now = (ahead[:, t - 1] @ step) * local[:, t]
        ahead[:, t] = now / now.sum(axis=1, keepdims=True)
    expected = np.zeros((labels, labels))
    for t in range(places - 2, -1, -1):
        inside = (t + 1 < lengths)[:, None]
        message = local[:, t + 1] * behind[:, t + 1]
        back = message @ step.T
        behind[:, t] = np.where(inside, back / back.sum(axis=1, keepdims=True), 1.0)
        pair = ahead[:, t][:, :, None] * step[None] * message[:, None, :]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        expected += pair[inside[:, 0]].sum(axis=0)
    marginals = ahead * behind
    return marginals / marginals.sum(axis=2, keepdims=True), expected


def _gradient_step(weights, squares, gradient, rows=None):
    """AdaGrad, on some rows or on all."""
    if rows is None:
        squares += gradient**2
        weights += RATE * gradient / np.sqrt(squares + 1e-8)
    else:
        squares[rows] += gradient**2
        weights[rows] += RATE * gradient / np.sqrt(squares[rows] + 1e-8)


def train_field(pieces: Sequence[tuple[str, bytes]], seed: int = 7, epochs: int = EPOCHS) -> Field:
    """A field from (label, text) pieces, by stochastic gradient ascent on the log-likelihood of mixed sequences."""
    labels = sorted({label for label, _ in pieces})
    k = len(labels)
    none = np.zeros(0, dtype=np.uint64)
    field = Field(labels, np.zeros((1 << BUCKET_BITS, k), np.float32), none, none.astype(np.int64), np.zeros((k + 1, k)), np.zeros((k, k)))
    words = split_words(pa.array([text for _, text in pieces], pa.binary()), lower=True, separators=_NOT_LETTER)
    types, number = distinct_words(words)
    tags = np.array([labels.index(label) for label, _ in pieces], dtype=np.int64)
    token_tags = np.repeat(tags, words.counts())
    good = types.is_word[number]
    per_label = np.stack([np.bincount(number[good & (token_tags == i)], minlength=len(types.hashes)) for i in range(k)]) if k else np.zeros((0, 0))
    texts: list[list[np.ndarray]] = [[] for _ in range(k)]
    for tag, a, b in zip(tags, words.first[:-1], words.first[1:]):
        mine = number[a:b][good[a:b]]
        if len(mine):
            texts[tag].append(mine)
    usable = [i for i in range(k) if texts[i]]
    if len(usable) < 2:
        return field
    listed = np.flatnonzero((per_label.max(axis=0) >= LEXICON_COUNT) & (per_label.max(axis=0) >= LEXICON_SHARE * per_label.sum(axis=0)))
    field = field._replace(lexicon=types.hashes[listed], lexicon_label=per_label.argmax(axis=0)[listed])
    rng = np.random.default_rng(seed)
    inputs, gold = np.zeros((SEQUENCES, LENGTH), np.int64), np.zeros((SEQUENCES, LENGTH), np.int64)
    for s in range(SEQUENCES):
        at = 0
        while at < LENGTH:
            tag = usable[rng.integers(len(usable))]
            text = texts[tag][rng.integers(len(texts[tag]))]
            size = min(int(rng.integers(6, 31)), LENGTH - at, len(text))
            begin = int(rng.integers(len(text) - size + 1))
            inputs[s, at : at + size], gold[s, at : at + size] = text[begin : begin + size], tag
            at += size
    gram_ends = np.append(types.begins[1:], len(types.grams))
    squares, lexicon_squares, step_squares = np.zeros_like(field.weights), np.zeros_like(field.lexicon_weights), np.zeros_like(field.transitions)
    full = np.full(BATCH, LENGTH)
    for _ in range(epochs):
        for batch in rng.permutation(SEQUENCES).reshape(-1, BATCH):
            used, place = np.unique(inputs[batch], return_inverse=True)
            sizes = gram_ends[used] - types.begins[used]
            stops = np.cumsum(sizes)
            grams = types.grams[np.arange(stops[-1]) + np.repeat(types.begins[used] - stops + sizes, sizes)]
            subset = Types(types.hashes[used], grams, stops - sizes, types.is_word[used])
            emissions = field.emissions(subset)[place.reshape(BATCH, LENGTH)]
            marginals, expected = forward_backward(emissions, full, field.transitions)
            wanted = gold[batch]
            error = -marginals
            np.put_along_axis(error, wanted[:, :, None], np.take_along_axis(error, wanted[:, :, None], 2) + 1, 2)
            of_type = np.stack([np.bincount(place.ravel(), weights=error[:, :, i].ravel(), minlength=len(used)) for i in range(k)], axis=1)
            seen = np.zeros((k, k))
            np.add.at(seen, (wanted[:, :-1].ravel(), wanted[:, 1:].ravel()), 1)
            rows, back = np.unique(grams, return_inverse=True)
            of_gram = np.repeat(of_type, sizes, axis=0)
            gradient = np.stack([np.bincount(back, weights=of_gram[:, i], minlength=len(rows)) for i in range(k)], axis=1)
            _gradient_step(field.weights, squares, (gradient / BATCH).astype(np.float32), rows)
            lexicon = np.zeros_like(field.lexicon_weights)
            np.add.at(lexicon, field.listed(subset.hashes), of_type)
            lexicon[k] = 0
            _gradient_step(field.lexicon_weights, lexicon_squares, lexicon / BATCH)
            _gradient_step(field.transitions, step_squares, (seen - expected) / BATCH)
    return field


def label_texts(field: Field, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Expected share of each label in each text (text, label), and its number of words."""
    words = split_words(column, lower=True, separators=_NOT_LETTER)
    types, number = distinct_words(words)
    good = types.is_word[number] if len(number) else np.zeros(0, dtype=bool)
    owner, number = words.owner()[good], number[good]
    counts = np.bincount(owner, minlength=len(column))
    k = len(field.labels)
    if not len(owner) or not k:
        return np.zeros((len(column), k)), counts
    by_type = field.emissions(types)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    begins = np.flatnonzero(place % CHAIN == 0)
    lengths = np.diff(np.append(begins, len(owner)))
    chain = np.repeat(np.arange(len(begins)), lengths)
    emissions = np.zeros((len(begins), int(lengths.max()), k))
    emissions[chain, place % CHAIN] = by_type[number]
    marginals, _ = forward_backward(emissions, lengths, field.transitions)
    each = marginals[chain, place % CHAIN]
    shares = np.stack([np.bincount(owner, weights=each[:, i], minlength=len(column)) for i in range(k)], axis=1)
    return shares / np.maximum(counts, 1)[:, None], counts


def training_pieces(docs: DataFrame, label_col: str, text_col: str, docs_per_label: int = DOCS_PER_LABEL) -> list[tuple[str, bytes]]:
    """(label, text) of the sample: at most `docs_per_label` texts of each label, of each at most PIECE characters."""
    text = F.col(f"`{text_col}`")
    labelled = docs.select(F.col(f"`{label_col}`").alias("label"), text.alias("text"), F.xxhash64(text).alias("hash")).filter(
        "label IS NOT NULL AND text IS NOT NULL AND text <> ''"
    )
    order = Window.partitionBy("label").orderBy("hash")
    chosen = labelled.select("label", "hash").distinct().withColumn("n", F.row_number().over(order)).filter(F.col("n") <= docs_per_label)
    begin = F.pmod(F.col("hash"), F.greatest(F.char_length("text") - PIECE, F.lit(0)) + 1).cast("int") + 1
    pieces = labelled.join(chosen.select("label", "hash"), ["label", "hash"]).select("label", "hash", F.substring(F.col("text"), begin, F.lit(PIECE)).alias("piece"))
    rows = pieces.groupBy("label", "hash").agg(F.min("piece").alias("piece")).orderBy("label", "hash").collect()
    return [(r.label, r.piece.encode()) for r in rows]


def identify_languages(
    docs: DataFrame, field: Field, text_col: str = "text", carry: Sequence[str] | None = None
) -> DataFrame:
    """`docs` with `lang_pred` and `score`, the expected share of the text's words in that language.

    A text that is NULL or has no letter, and any text when no label was learned, is `und` with score 0. The whole
    text is read. Of equal shares the first label in string order wins. Repeated rows are each labelled; an empty
    table stays empty. Columns that clash with a result column are replaced; `carry` names the columns to return
    besides (default: all).
    """
    names = [c for c in without(docs, RESULT).columns if carry is None or c in carry]
    rows = docs.select(*[F.col(f"`{c}`") for c in names], utf8(F.col(f"`{text_col}`")).alias("_text"))
    held = docs.sparkSession.sparkContext.broadcast(field)
    schema = rows.select(*[F.col(f"`{c}`") for c in names]).schema.add("lang_pred", "string").add("score", "double")

    def predict(batches):
        field = held.value
        for batch in slices(batches, "_text"):
            shares, counts = label_texts(field, batch["_text"])
            if field.labels:
                best, known = shares.argmax(axis=1), counts > 0
                labels = [field.labels[b] if k else UNDETERMINED for b, k in zip(best.tolist(), known.tolist())]
                scores = np.where(known, np.clip(shares.max(axis=1), 0, 1), 0.0)
            else:
                labels, scores = [UNDETERMINED] * batch.num_rows, np.zeros(batch.num_rows)
            arrays = [batch[c] for c in names] + [pa.array(labels, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "lang_pred", "score"])

    return rows.mapInArrow(predict, schema)
