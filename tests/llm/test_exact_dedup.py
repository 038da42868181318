import hashlib
import re

import pytest

from postlens.llm.exact_dedup import drop_exact_duplicates, exact_duplicates

ROWS = [
    (5, "a b c"), (2, "abc"), (9, " a bc "), (1, "a  b  c"), (7, "a  b  c"), (None, "abd"), (3, "abd"),
    (4, None), (8, ""), (6, " \n\t\x0b\x0c\r"), (10, "é😀 x"), (11, "é😀x"), (12, "alone"), (12, "alone"), (13, "Abc"),
]


def expected(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), i is None, i or 0, i))
    out = []
    for key, members in groups.items():
        best = min(members)[3]
        out += [(m[3], best, len(members), hashlib.sha256(key.encode()).hexdigest()) for m in members]
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [1, 15, 27])
def test_groups(spark, bits):
    docs = spark.createDataFrame(ROWS * 3 if bits == 1 else ROWS, "doc_id long, text string")
    rows = exact_duplicates(docs, max_bits=bits).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows], key=str) == expected(ROWS * 3 if bits == 1 else ROWS)
    kept = [r for r in rows if r.kept]
    assert len(kept) == len({r.text_sha256 for r in rows}) and all(r.doc_id == r.keep_id for r in kept)


def test_kept_rows_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "x y", "mine", 3), (2, "xy", "yours", 4)], "doc_id long, text string, kept string, _row int")
    (row,) = exact_duplicates(docs).filter("kept").collect()
    assert row.doc_id == 1 and row.group_size == 2
    plain = spark.createDataFrame([(1, "x y", "mine"), (2, "xy", "yours"), (3, "z", None)], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.source) for r in drop_exact_duplicates(plain).collect()) == [(1, "mine"), (3, None)]


def test_empty_table(spark):
    assert exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_no_python_in_the_plan(spark, sf):
    from postlens.llm.catalog import QUERIES

    for name in ("op7_exact_dedup", "op10_secret_scan"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
