import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from test_decontaminate import brute as hits_of  # noqa: E402
from test_mixing import draw, poisson  # noqa: E402
from test_near_dedup import brute as components_of  # noqa: E402

import corpus_pipeline  # noqa: E402
from __spark_entry__ import queries  # noqa: E402
from postlens.llm.token_shards import END_TOKEN  # noqa: E402


@pytest.fixture(scope="module")
def outputs(spark, sf, tmp_path_factory):
    """What each stage returned, written and read again."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("pipeline") / name)
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def rows_of(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_stages_keep_the_columns(spark, sf, outputs):
    columns = spark.read.parquet(f"{sf}/documents.parquet").columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "mix", "token_shards"]
    assert all(frame.columns == columns for frame in outputs[:-1])


def test_decisions_equal_brute_force(spark, sf, outputs):
    documents = rows_of(spark.read.parquet(f"{sf}/documents.parquet"))
    read, unique, clean, mixed, tokens = outputs
    assert len(rows_of(read)) >= 0.97 * len(documents)
    assert set(rows_of(unique)) == {i for i, _, least in components_of(sorted(rows_of(read).items())) if i == least}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    found = hits_of(sorted(rows_of(unique).items()), items, 10)
    assert set(rows_of(clean)) == {i for i, (_, hit, _) in found.items() if not hit}
    sources = {r.doc_id: r.source for r in clean.collect()}
    sizes = {s: list(sources.values()).count(s) for s in set(sources.values())}
    scale = len(sources) / sum(n**0.7 for n in sizes.values())
    counts = {i: poisson(sizes[s] ** 0.7 * scale / sizes[s], draw(i)) for i, s in sources.items()}
    drawn = [r.doc_id for r in mixed.collect()]
    assert {i: drawn.count(i) for i in sources} == counts
    rows = tokens.collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    ends = sum(int(np.frombuffer(bytes(r.tokens), "<u2")[r.n_tokens - 1] == END_TOKEN) for r in rows)
    assert ends == len(drawn)


def test_registered(spark, sf):
    assert queries()["pipeline"](spark, sf).count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).collect() == []


def test_language_id_keeps_mixed_documents_and_all_without_labels(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {}
    for r in docs.filter("lang IS NOT NULL AND n_chars > 200").orderBy("doc_id").collect():
        texts.setdefault(r.lang, " ".join(r.text.split()[:30]))
    assert len(texts) >= 3
    planted = spark.createDataFrame(
        [(10**9, " ".join(texts.values()), None, "src0", 1), (10**9 + 1, "12 34 -- 56", None, "src0", 1)], docs.schema
    )
    read = corpus_pipeline.language_id(spark, docs.unionByName(planted), sf)
    assert [r.doc_id for r in read.filter("doc_id >= 1000000000").collect()] == [10**9]
    unlabelled = docs.limit(20).withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language_id(spark, unlabelled, sf).count() == 20
