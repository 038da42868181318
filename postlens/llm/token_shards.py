"""Token ids in training order: fixed-stride binary shards.

Every document's tokens and an end token are cut into sequences of one length, the last one padded. The sequences are
written once and numbered in that order from per-partition counts. A keyed Feistel permutation with cycle-walking maps
the numbers onto themselves; its result is a sequence's global slot. Range partitions of slots are the shards: a slot
lies at byte `offset` of its shard, so reading resumes at any slot with one seek, and no permutation is stored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.frames import slices, utf8, without
from postlens.llm.words import mix
from postlens.session import materialise

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed values of that vocabulary: how it splits text, and its free id, which ends and pads sequences.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
END_TOKEN = 50256

SEQUENCE, PER_SHARD, KEY, ROUNDS = 512, 4096, 0x5DEECE66D, 6
RESULT = ("slot", "shard", "offset", "chunk", "n_tokens", "tokens")
_POSITION_BITS = 33  # monotonically_increasing_id: partition number above, position in the partition below
_KNOWN = 400_000

#: White space outside ASCII: texts with it are encoded as a whole, not piece by piece.
_WIDE_SPACE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_PIECE = re.compile("[ \t\n\r\x0b\x0c]*[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+")


class Encoder:
    """Encodes texts to little-endian 16-bit ids; pieces that begin at white space are looked up when seen again.

    The vocabulary's splits never cross from other characters into white space, so a text is the sum of such pieces.
    """

    def __init__(self, ranks: bytes):
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line)
        merges = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.encoding = tiktoken.Encoding("shards", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
        self.known: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), dtype="<u2").tobytes()

    def encode(self, text: str) -> bytes:
        if not text.isascii() and _WIDE_SPACE.search(text):
            return self._whole(text)
        pieces, known = _PIECE.findall(text), self.known
        try:
            return b"".join(map(known.__getitem__, pieces))
        except KeyError:
            if len(known) > _KNOWN:
                known.clear()
            for piece in set(pieces).difference(known):
                known[piece] = self._whole(piece)
            return b"".join(map(known.__getitem__, pieces))


def token_sequences(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, length: int) -> DataFrame:
    """(id, chunk, n_tokens, tokens): each document's tokens and its end in sequences of `length` ids."""
    with open(tokenizer, "rb") as file:  # a vocabulary of fixed size, on the driver
        held = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(f"`{id_col}`"), utf8(F.col(f"`{text_col}`")).alias("_text"))
    schema = rows.select(F.col(f"`{id_col}`")).schema.add("chunk", "integer").add("n_tokens", "integer").add("tokens", "binary")
    end, stride = np.array([END_TOKEN], dtype="<u2").tobytes(), 2 * length

    def encode(batches):
        encoder = Encoder(held.value)
        for batch in slices(batches, "_text"):
            row, chunk, sizes, tokens = [], [], [], []
            for i, text in enumerate(batch["_text"]):
                ids = encoder.encode((text.as_py() or b"").decode("utf-8", "replace")) + end
                for at in range(0, len(ids), stride):
                    part = ids[at : at + stride]
                    row.append(i)
                    chunk.append(at // stride)
                    sizes.append(len(part) // 2)
                    tokens.append(part + end * (length - len(part) // 2))
            arrays = [batch[id_col].take(pa.array(row, pa.int64())), pa.array(chunk, pa.int32()), pa.array(sizes, pa.int32()), pa.array(tokens, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=[id_col, "chunk", "n_tokens", "tokens"])

    return rows.mapInArrow(encode, schema)


def permute(numbers: np.ndarray, size: int, key: int = KEY, rounds: int = ROUNDS) -> np.ndarray:
    """A keyed permutation of 0 .. size - 1: a balanced Feistel network over the next even power of two, walked along
    its cycles until the result is in range (less than four steps on average)."""
    half = max(1, ((max(size, 2) - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = mix(np.uint64(key) + np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    out = numbers.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> np.uint64(half), out[walking] & low
        for k in keys:
            left, right = right, left ^ (mix(right + k) & low)
        out[walking] = left << np.uint64(half) | right
        walking = walking[out[walking] >= size]
    return out.astype(np.int64)


def materialise_order(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
    length: int = SEQUENCE,
    per_shard: int = PER_SHARD,
    key: int = KEY,
) -> DataFrame:
    """One row for each sequence: its document's id, `chunk` (from 0), `n_tokens` (without padding), global `slot`,
    `shard`, byte `offset` in the shard and the `tokens` (16-bit little-endian ids, all sequences of one length).

    Rows are partitioned by ranges of shards and sorted by slot. NULL and empty texts are one sequence that holds the
    end token alone; repeated rows each have their sequences; an empty table gives none. Only the id is returned
    besides; it must not have the name of a result column. The same rows in the same order, with the same key, give
    the same slots.
    """
    sequences = token_sequences(without(docs, [c for c in RESULT if c not in (id_col, text_col)]), id_col, text_col, tokenizer, length)
    written = materialise(sequences.withColumn("_at", F.monotonically_increasing_id()), "sequences")
    partition = F.shiftright("_at", _POSITION_BITS)
    sizes = written.groupBy(partition.alias("_part")).count()
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))  # a row per partition
    total = sizes.agg(F.sum("count")).first()[0] or 0

    @F.pandas_udf(T.LongType())
    def slot(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), total, key))

    inside = F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    numbered = written.withColumn("_part", partition).join(F.broadcast(offsets), "_part").withColumn("slot", slot(F.col("_before") + inside))
    placed = numbered.select(
        F.col(f"`{id_col}`"),
        "chunk",
        "n_tokens",
        "slot",
        F.floor(F.col("slot") / per_shard).alias("shard"),
        (F.col("slot") % per_shard * (2 * length)).alias("offset"),
        "tokens",
    )
    return placed.repartitionByRange(F.col("shard")).sortWithinPartitions("slot")


def write_shards(sequences: DataFrame, folder: str) -> None:
    """Write `shard-<number>.bin` files below a folder that all executors reach; complete shards are left as they are.

    Each shard is written by one task, under another name first, so a task that is run again does no harm.
    """

    def write(rows: Iterable) -> None:
        system, root = pafs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        stream, current, name = None, None, None
        for row in rows:
            if row.shard != current:
                if stream is not None:
                    stream.close()
                    system.move(name + ".part", name)
                current, name = row.shard, f"{root}/shard-{row.shard:08d}.bin"
                done = system.get_file_info(name).type == pafs.FileType.File
                stream = None if done else system.open_output_stream(name + ".part")
            if stream is not None:
                stream.write(row.tokens)
        if stream is not None:
            stream.close()
            system.move(name + ".part", name)

    sequences.select("shard", "tokens").foreachPartition(write)


def read_sequences(folder: str, slot: int, count: int, length: int = SEQUENCE, per_shard: int = PER_SHARD) -> np.ndarray:
    """The token ids of up to `count` slots from `slot` on, as rows."""
    system, root = pafs.FileSystem.from_uri(folder)
    out, stride = [], 2 * length
    while count > 0:
        name = f"{root}/shard-{slot // per_shard:08d}.bin"
        if system.get_file_info(name).type != pafs.FileType.File:
            break
        wanted = min(count, per_shard - slot % per_shard)
        with system.open_input_file(name) as file:
            file.seek(slot % per_shard * stride)
            ids = np.frombuffer(file.read(wanted * stride), dtype="<u2").reshape(-1, length)
        out.append(ids)
        if len(ids) < wanted:
            break
        slot, count = slot + wanted, count - wanted
    return np.concatenate(out) if out else np.zeros((0, length), dtype="<u2")
