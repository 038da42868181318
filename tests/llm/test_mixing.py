import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from postlens.llm.mixing import SEED, expected_documents, mix_sources, source_rates


def poisson(rate, u):
    """Smallest k with P(X <= k) > u."""
    p = total = math.exp(-rate)
    k = 0
    while total <= u and k < 10_000:
        k += 1
        p *= rate / k
        total += p
    return k


def draw(i, part=1, seed=SEED):
    name = "~" if i is None else i
    return int(hashlib.md5(f"{seed}|{name}|{part}".encode()).hexdigest()[:13], 16) / 2**52


def table(spark):
    rows = [(i, f"t{i}", "big" if i % 3 else "small") for i in range(300)] + [(1000, None, None), (None, "", "lone")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_counts_invert_the_distribution(spark):
    docs = table(spark)
    weights = spark.createDataFrame([("big", 1.0), ("small", 3.0), (None, 0.1), ("absent", 5.0)], "source string, weight double")
    rates = source_rates(docs, weights=weights, epochs=2.0)
    by_source = {r.source: r.rate for r in rates.collect()}
    assert by_source["lone"] == 0 and by_source["small"] == pytest.approx(3 * 302 * 2 / 4.1 / 100)
    counts = Counter(r.doc_id for r in mix_sources(docs, rates).collect())
    expected = {r.doc_id: poisson(by_source[r.source], draw(r.doc_id)) for r in docs.collect()}
    assert counts == Counter({i: n for i, n in expected.items() if n})


def test_large_rates_are_sums_of_draws(spark):
    docs = spark.createDataFrame([(i, "x") for i in range(40)], "doc_id long, source string")
    rates = source_rates(docs, epochs=700.0)
    counts = Counter(r.doc_id for r in mix_sources(docs, rates).collect())
    assert counts == Counter({i: sum(poisson(700 / 3, draw(i, part)) for part in (1, 2, 3)) for i in range(40)})
    mean, deviation = expected_documents(700.0, 40)
    assert abs(sum(counts.values()) - mean) < 5 * deviation


def test_shares_follow_the_weights(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 4000, "hot").otherwise("cold").alias("source"))
    weights = spark.createDataFrame([("hot", 1.0), ("cold", 1.0)], "source string, weight double")
    sizes = {r.source: r["count"] for r in mix_sources(docs, source_rates(docs, weights=weights)).groupBy("source").count().collect()}
    for n in sizes.values():
        mean, deviation = expected_documents(0.5, 6000)
        assert abs(n - mean) < 5 * deviation


def test_order_is_shuffled_and_repeatable(spark):
    docs = table(spark)
    first = [(r.doc_id, r.replica) for r in mix_sources(docs, source_rates(docs)).collect()]
    again = [(r.doc_id, r.replica) for r in mix_sources(docs.repartition(3), source_rates(docs)).collect()]
    assert first == again and first != sorted(first, key=str)


def test_repeats_clashes_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "s", "mine", 2), (1, "s", "mine", 2)], "doc_id long, source string, replica string, rate int")
    rows = mix_sources(docs, source_rates(docs, epochs=3.0)).collect()
    assert len(rows) == 2 * poisson(3.0, draw(1)) and all(r.rate == 2 and isinstance(r.replica, int) for r in rows)
    assert mix_sources(docs.limit(0), source_rates(docs.limit(0))).collect() == []
