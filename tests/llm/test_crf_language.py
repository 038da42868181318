import itertools

import numpy as np
import pyarrow as pa
import pytest

from postlens.llm.catalog import QUERIES
from postlens.llm.crf_language import Field, forward_backward, identify_languages, label_texts, train_field, training_pieces


@pytest.fixture(scope="module")
def field(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return train_field(training_pieces(docs, "lang", "text"))


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    emissions, transitions = rng.normal(size=(3, 4, 3)), rng.normal(size=(3, 3))
    lengths = np.array([4, 2, 1])
    marginals, expected = forward_backward(emissions, lengths, transitions)
    pairs = np.zeros((3, 3))
    for chain, length in enumerate(lengths):
        weight, sums = 0.0, np.zeros((length, 3))
        steps = np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=length):
            w = np.exp(sum(emissions[chain, t, y] for t, y in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:])))
            weight += w
            for t, y in enumerate(path):
                sums[t, y] += w
            for a, b in zip(path, path[1:]):
                steps[a, b] += w
        assert np.allclose(marginals[chain, :length], sums / weight)
        pairs += steps / weight
    assert np.allclose(expected, pairs)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = QUERIES["op2_crf_language"](spark, sf_dir).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(langs) and all(0 <= r.score <= 1 for r in rows)
    unseen = [r for r in rows if r.held_out and r.lang_pred != "und"]
    assert len(unseen) > 250 and np.mean([r.lang_pred == langs[r.doc_id] for r in unseen]) > 0.98


def test_code_switched_text_is_split_between_labels(spark, field):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("n_chars > 600")
    english, french = (docs.filter(f"lang = '{lang}'").first().text[:500] for lang in ("en", "fr"))
    shares, _ = label_texts(field, pa.array([english + " " + french]))
    at = [field.labels.index("en"), field.labels.index("fr")]
    assert shares[0, at].min() > 0.3


def test_odd_texts(spark, field):
    rows = [(1, None), (2, ""), (3, "12 !? — … 漢"), (4, "123 — … ！ ２"), (5, "the and of " * 20000), (5, "the and of " * 20000), (6, "\x00\x01")]
    docs = spark.createDataFrame([(*r, "mine", 1) for r in rows], "doc_id long, text string, score string, lexicon int")
    found = identify_languages(docs, field).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    assert [by_id[i].lang_pred for i in (1, 2, 4, 6)] == ["und"] * 4 and by_id[1].score == 0
    assert by_id[3].lang_pred in field.labels and by_id[5].lang_pred == "en" and by_id[5].lexicon == 1
    assert identify_languages(docs.limit(0), field).collect() == []


def test_few_labels(spark):
    assert train_field([]).labels == []
    docs = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    (row,) = identify_languages(docs, train_field([])).collect()
    assert (row.lang_pred, row.score) == ("und", 0.0)
    (row,) = identify_languages(docs, train_field([("xx", b"abc def")])).collect()
    assert (row.lang_pred, row.score) == ("xx", 1.0)
    assert isinstance(train_field([("xx", b"1"), ("yy", b"")]), Field)


def test_sample_is_bounded_and_distinct(spark):
    rows = [("same text", "a")] * 50 + [(f"text {i}", "a") for i in range(30)] + [(f"mot {i}", "b") for i in range(5)] + [("x", None), (None, "b"), ("", "b")]
    pieces = training_pieces(spark.createDataFrame(rows, "text string, lang string"), "lang", "text", docs_per_label=10)
    assert len(pieces) == len(set(pieces)) == 15
