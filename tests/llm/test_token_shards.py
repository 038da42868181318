import base64

import numpy as np
import pytest
import tiktoken

from postlens.llm.token_shards import (
    END_TOKEN,
    PATTERN,
    TOKENIZER,
    Encoder,
    materialise_order,
    permute,
    read_sequences,
    write_shards,
)


@pytest.fixture(scope="module")
def plain():
    with open(TOKENIZER, "rb") as file:
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in file if line.strip())}
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    with open(TOKENIZER, "rb") as file:
        return Encoder(file.read())


TEXTS = [
    "", " ", "\n", "a", "Hello, world!  Two  spaces\n\n\nlines \n x", "it's we'll\tтест  é́ 漢字  ", "a\xa0 b　　 c  d",
    "\x1c \x1d x\x0b\x0cy", "  lead", "trail   ", "12 345\r\n6", "<|endoftext|> x", "word " * 3000,
]


@pytest.mark.parametrize("text", TEXTS)
def test_pieces_encode_like_the_whole(plain, encoder, text):
    assert np.frombuffer(encoder.encode(text), "<u2").tolist() == plain.encode_ordinary(text)


@pytest.mark.parametrize("size", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation(size):
    slots = permute(np.arange(size), size, key=99)
    assert sorted(slots) == list(range(size))
    if size > 100:
        assert (slots != np.arange(size)).mean() > 0.9 and (permute(np.arange(size), size, key=100) != slots).any()
    assert (permute(np.arange(size)[::-1], size, key=99) == slots[::-1]).all()


def rebuilt(rows, plain):
    out = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.chunk)):
        ids = np.frombuffer(bytes(r.tokens), "<u2")
        assert (ids[r.n_tokens :] == END_TOKEN).all()
        out.setdefault(r.doc_id, []).extend(ids[: r.n_tokens].tolist())
    assert all(ids[-1] == END_TOKEN for ids in out.values())
    return {i: plain.decode(ids[:-1]) for i, ids in out.items()}


def test_round_trip(spark, plain, tmp_path):
    docs = spark.createDataFrame([*enumerate(TEXTS), (50, None)], "doc_id long, text string")
    ordered = materialise_order(docs.repartition(3), length=16, per_shard=7)
    rows = ordered.collect()
    assert rebuilt(rows, plain) == {**dict(enumerate(TEXTS)), 50: ""}
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert all((r.shard, r.offset) == (r.slot // 7, r.slot % 7 * 32) and len(r.tokens) == 32 for r in rows)
    folder = f"file://{tmp_path}/shards"
    write_shards(ordered, folder)
    write_shards(ordered, folder)
    by_slot = {r.slot: np.frombuffer(bytes(r.tokens), "<u2").tolist() for r in rows}
    everything = read_sequences(folder, 0, len(rows) + 5, 16, 7)
    assert everything.tolist() == [by_slot[s] for s in range(len(rows))]
    assert read_sequences(folder, 11, 9, 16, 7).tolist() == [by_slot[s] for s in range(11, 20)]
    assert len(read_sequences(folder, len(rows) + 100, 3, 16, 7)) == 0


def test_repeats_clashes_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b", "s", 3)] * 2, "doc_id long, text string, shard string, chunk int")
    rows = materialise_order(docs).collect()
    assert [r.slot for r in rows] == [0, 1] and rows[0].tokens == rows[1].tokens
    assert materialise_order(docs.limit(0)).collect() == []


def test_slots_of_a_table_are_stable(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    slots = lambda: sorted((r.doc_id, r.chunk, r.slot) for r in materialise_order(docs).select("doc_id", "chunk", "slot").collect())
    assert slots() == slots()
