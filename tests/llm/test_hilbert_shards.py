import zlib

import numpy as np
import pytest

from postlens.llm.hilbert_shards import cells, curve_index, shard_by_curve, write_shards


@pytest.mark.parametrize("dimensions, bits", [(2, 4), (3, 3), (4, 2), (1, 5)])
def test_curve_visits_every_cell_in_steps_of_one(dimensions, bits):
    grid = np.stack(np.meshgrid(*[np.arange(2**bits)] * dimensions, indexing="ij"), -1).reshape(-1, dimensions)
    index = curve_index(grid, bits)
    assert sorted(index) == list(range(len(grid)))
    path = grid[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_cells_keep_the_order():
    values = np.array([np.nan, 1.0, 5.0, 5.5, 9.0, 100.0])
    got = cells(values, [1.0, 5.0, 9.0], 8)
    assert list(got) == sorted(got) and got.max() < 256 and got[0] == 0 and got[2] < got[3]


def rows_of(spark, count):
    texts = [None, "", "é", "same", "same"]
    rows = [(i if i % 11 else None, texts[i % 7] if i % 7 < 5 else f"t{i}", ["en", "fr", None][i % 3], i * 37 % 101) for i in range(count)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")


@pytest.mark.parametrize("count, shards", [(100, 16), (7, 16), (64, 5), (1, 3)])
def test_law_of_rows(spark, count, shards):
    docs = rows_of(spark, count)
    rows = shard_by_curve(docs, ["lang", "n_chars"], shards).collect()
    assert len(rows) == count
    sizes = [0] * shards
    for shard in range(shards):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
        sizes[shard] = len(slots)
    assert sum(sizes) == count and max(sizes) - min(sizes) <= 1
    for r in rows:
        data = (r.text or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)


def test_shards_are_narrow_in_every_dimension(spark):
    rows = [(i, "x", f"s{i % 20:02d}", i * 7919 % 1000) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    found = shard_by_curve(docs, ["source", "n_chars"]).toPandas()
    spread = found.groupby("shard").agg(sources=("source", "nunique"), low=("n_chars", "min"), high=("n_chars", "max"))
    assert spread.sources.mean() < 12 and (spread.high - spread.low).mean() < 600


def test_clashing_columns_files_and_empty_table(spark, tmp_path):
    docs = rows_of(spark, 30).selectExpr("*", "n_chars AS size", "'x' AS rank")
    sharded = shard_by_curve(docs, ["size", "lang"], 4)
    assert sharded.columns.count("size") == 1 and "rank" in sharded.columns
    write_shards(sharded, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 30 and back.select("shard").distinct().count() == 4
    assert shard_by_curve(docs.limit(0), ["lang"]).collect() == []


def test_texts_with_a_common_prefix_fall_in_cells_of_their_own(spark):
    rows = [(i, "x", f"commoncrawl-2023-{i % 20:02d}", i * 7919 % 1000) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    found = shard_by_curve(docs, ["source", "n_chars"]).toPandas()
    spread = found.groupby("shard").agg(sources=("source", "nunique"), low=("n_chars", "min"), high=("n_chars", "max"))
    assert len(found) == 4000 and spread.sources.mean() < 12 and (spread.high - spread.low).mean() < 600
