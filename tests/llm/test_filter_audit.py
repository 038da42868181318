import itertools
import random
import re

import pytest

from postlens.llm.filter_audit import Diagram, audit_filters, audit_part, document_failures, plain_changes

COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def failures(docs):
    """Letters each document fails, by the definitions."""
    out = []
    for i, text, _ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = ""
        fails += "A" if len(words) < 50 else ""
        fails += "B" if 100 * len(set(words)) < 65 * len(words) else ""
        fails += "C" if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else ""
        fails += "D" if re.search("[#$%&*|]", text) else ""
        fails += "E" if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs) else ""
        out.append(fails)
    return out


def brute(docs, labels):
    marks = {i: (any(q == 1 for j, q, _ in labels if j == i), any(t == 1 for j, _, t in labels if j == i)) for i, *_ in labels if i is not None}
    rows, fails = [], failures(docs)
    for part in {s or "" for *_, s in docs}:
        mine = [(i, f) for (i, _, s), f in zip(docs, fails) if (s or "") == part]
        of_filter, mine_rows = dict.fromkeys("ABCDE", 0), []
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                of_filter[letter] += len(gone)
                lost = [sum(marks.get(i, (False, False))[k] for i, _ in gone) for k in (0, 1)]
                all_of = sum(letter in f for _, f in mine)
                mine_rows.append((part, order, step, len(left), len(gone), all_of - len(gone), sum(f == letter for _, f in mine), *lost))
        rows += [(*r, of_filter[r[1][r[2] - 1]]) for r in mine_rows]
    return sorted(rows)


def long_text(rng, vocabulary, words):
    return " ".join(rng.choice(vocabulary) for _ in range(words))


def corpus():
    rng = random.Random(11)
    wide, narrow = [f"w{k}" for k in range(900)], ["x", "y", "Zed"]
    texts = [None, "", " \n\x0b", "short text", "A#B", long_text(rng, wide, 50), long_text(rng, wide, 49), long_text(rng, narrow, 60)]
    texts += [long_text(rng, wide, 70) + " 5% off", "ÉÀ " + long_text(rng, wide, 60), "AB " + long_text(rng, wide, 12), long_text(rng, wide, 52).upper()]
    docs = [(k + 3, rng.choice(texts), rng.choice(["a", "b", None, ""])) for k in range(60)]
    docs += [(None, "short text", "a"), (None, None, "c"), (3, docs[0][1], "b"), (3, docs[0][1], "b"), (1, texts[8], "only")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(1, 50)] + [(7, 1, 1), (7, 0, 0), (None, 1, 1)]
    return docs, labels


def test_all_orders_against_brute_force(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "1 AS key", "'k' AS A", "true AS good")
    flags = document_failures(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    rows = audit_filters(flags, "part", marks=("good", "toxic")).select(*COLUMNS).collect()
    assert sorted(map(tuple, rows)) == brute(docs, labels)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_filters(document_failures(docs, labels), "part", marks=("good", "toxic")).collect() == []
    one = spark.createDataFrame([(1, "x", None)], docs.schema)
    rows = audit_filters(document_failures(one, labels), "part", marks=("good", "toxic")).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""} and sum(r.good_lost for r in rows) == 0


def test_very_long_text_and_hot_part(spark):
    long = "word " * 600_000 + "".join(f"w{k} " for k in range(9))
    docs = [(1, long, "hot"), (2, long, "hot"), (3, long + "x", "hot")] + [(k, "same text", "hot") for k in range(4, 300)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    flags = document_failures(frame, spark.createDataFrame([(2, 1, 1)], "doc_id long, quality int, toxic int"))
    rows = {(r.filter_order, r.step): r for r in audit_filters(flags, "part", marks=("good", "toxic")).collect()}
    assert rows["BAECD", 1].removed == 3 and rows["EBACD", 1].removed == 296 and rows["EBACD", 1].good_lost == 1
    assert rows["EBACD", 2].removed == 2 and rows["EBACD", 2].redundant == 1 and rows["AEBCD", 1].unique_fails == 1


def test_diagram_is_reduced_and_swaps_restore_it():
    counts = {0: (4,), 1: (4,), 2: (1,), 3: (1,)}  # filter 0 tells nothing: both its edges lead to one node
    diagram = Diagram(2, counts)
    assert len(diagram.weights[2]) == 2
    before = (diagram.steps(), list(diagram.order))
    diagram.swap(0)
    assert [len(layer) for layer in diagram.layers] == [1, 2] and diagram.order == [1, 0]
    diagram.swap(0)
    assert (diagram.steps(), diagram.order) == before


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_plain_changes_reach_every_order_once(n):
    order = list(range(n))
    seen = [tuple(order)]
    for k in plain_changes(n):
        order[k], order[k + 1] = order[k + 1], order[k]
        seen.append(tuple(order))
    assert sorted(seen) == sorted(itertools.permutations(range(n)))


def test_filters_are_checked(spark):
    flags = spark.createDataFrame([("p", True, None)], "part string, X boolean, Y boolean")
    rows = audit_filters(flags, "part", filters="XY").collect()
    assert sorted((r.filter_order, r.step, r.kept, r.removed, r.shapley) for r in rows) == [
        ("XY", 1, 0, 1, 2), ("XY", 2, 0, 0, 0), ("YX", 1, 1, 0, 0), ("YX", 2, 0, 1, 2)
    ]
    for wrong in ("", "XX", "ABCDEFGH", ["AB"]):
        with pytest.raises(ValueError):
            audit_filters(flags, "part", filters=wrong)
    assert len(audit_part("A", {0: (1,)})) == 1
