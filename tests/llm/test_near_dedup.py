import random
import re

import numpy as np
import pytest

from postlens.llm import near_dedup
from postlens.llm.components import components
from postlens.llm.near_dedup import drop_near_duplicates, near_duplicates


def shingles(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    label = {k: k for k in range(len(sets))}
    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a & b and 100 * len(a & b) >= 75 * len(a | b):
                old, new = label[x], label[y]
                label = {k: new if v == old else v for k, v in label.items()}
    least = {}
    for k, (i, _) in enumerate(sets):
        least[label[k]] = min(least.get(label[k], i), i)
    return sorted((i, len(s), least[label[k]]) for k, (i, s) in enumerate(sets))


def corpus(seed, groups=6, copies=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    common = rng.choices(vocabulary, k=40)
    docs = []
    for _ in range(groups):
        words = rng.choices(vocabulary, k=rng.choice([3, 7, 30, 150])) + common
        for _ in range(copies):
            for _ in range(rng.choice([0, 0, 1, 2])):
                words = list(words)
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            docs.append(" ".join(words))
    docs += [" ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 4, 5, 6, 20]))) for _ in range(20)] + ["a b c", "A  b C", "a b", "x"] * 2
    rng.shuffle(docs)
    return [(i + 10, t) for i, t in enumerate(docs)] + [(1, None), (2, ""), (3, " \n")]


@pytest.mark.parametrize("seed, lists, block, whole", [(1, 40, 1024, 1024), (2, 3, 4, 1024), (3, 2, 3, 20)])
def test_components_of_documents(spark, monkeypatch, seed, lists, block, whole):
    """Also with short lists and small blocks, and with sets that are larger than what blocks compare whole."""
    monkeypatch.setattr(near_dedup, "LIST", lists)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "WHOLE", whole)
    docs = corpus(seed)
    rows = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == brute(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_limit_is_exact(spark):
    three, four = "a b c d e f g", "a b c d e f g h"  # sets of 3 and 4 shingles: 3 / 4
    five = "a b c d e f g h i"  # 3 / 5 with the first, 4 / 5 with the second
    docs = spark.createDataFrame([(3, three), (2, four), (7, "q " + three + " z"), (1, five)], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_duplicates(docs).collect()} == {3: 1, 2: 1, 1: 1, 7: 7}


def test_repeats_clashes_and_empty_table(spark):
    rows = [(4, "a b c d e f", "x", 1), (4, "a b c d e f", "x", 1), (6, "A b c d e f", "y", 2), (None, "z", "n", 3), (9, "z z", "k", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n int")
    found = near_duplicates(docs.select("doc_id", "text", "source")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.source) for r in found) == [(0, 0, "n"), (4, 4, "x"), (4, 4, "x"), (6, 4, "y"), (9, 9, "k")]
    assert sorted((r.doc_id or 0, r.n) for r in drop_near_duplicates(docs).collect()) == [(0, 3), (4, 1), (9, 4)]
    assert near_duplicates(docs.limit(0)).collect() == []


def test_components_of_a_chain_a_star_and_pairs(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(500, 300), (7, 7), (500, 300)]
    random.Random(1).shuffle(edges)
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    found = {r.node: r.component for r in rows}
    assert len(rows) == len(found)
    assert all(found[i] == 1 for i in range(1, 41)) and all(found[100 + i] == 100 for i in range(30)) and found[500] == found[300] == 300
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def around_seven_words():
    """A 7-word text, 499 extensions of 8 words and, for 500 more texts, unlike ones that share a shingle with it."""
    base = "a b c d e f g".split()
    rows = [" ".join(base)] + [" ".join([*base, f"x{i}"]) for i in range(499)]
    rows += [" ".join([f"p{i}", f"q{i}", *base[:5], f"r{i}", f"s{i}"]) for i in range(500)]
    return [(i + 1, t) for i, t in enumerate(rows)]


def test_no_link_of_short_texts_is_lost_in_crowded_lists(spark):
    docs = around_seven_words()
    rows = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == brute(docs)


def test_no_link_inside_boilerplate_is_lost(spark):
    """Thousands share a passage of 40%; pairs of near copies in it are linked with nothing else."""
    rng = random.Random(5)
    common, docs = [f"c{k}" for k in range(60)], []
    for i in range(1200):
        own = [f"o{i}x{k}" for k in range(90)]
        docs.append((2 * i + 1, " ".join(common + own)))
        if i % 100 == 7:
            own[rng.randrange(10, 80)] = "changed"
            docs.append((2 * i + 2, " ".join(common + own)))
    rows = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in rows} == {i: i - 1 + i % 2 for i, _ in docs}


def test_a_chain_of_2000_versions_is_one_component(spark):
    """Versions share a passage of a third; each is similar to a few neighbours only."""
    common, words = [f"c{k}" for k in range(20)], [f"v{k}" for k in range(2 * 2000 + 40)]
    docs = [(i + 1, " ".join(common + words[2 * i : 2 * i + 40])) for i in range(2000)]
    near = shingles(docs[0][1]), shingles(docs[1][1]), shingles(docs[40][1])
    assert 100 * len(near[0] & near[1]) >= 75 * len(near[0] | near[1]) and 100 * len(near[0] & near[2]) < 75 * len(near[0] | near[2])
    rows = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.component_id for r in rows} == {1}


def test_links_that_join_and_the_least_shared_values():
    left, right = [5, 5, 7, 9, 5], [6, 6, 8, 5, 9]
    assert near_dedup._joining(np.array(left), np.array(right)) == [0, 2, 3]
    steps = near_dedup._least_by_size(75)
    assert [least for _, least in steps] == sorted({least for _, least in steps}, reverse=True) and steps[-1][1] > 27
    assert near_dedup.sampled_least(75, 64, 64) == 48 and near_dedup.sampled_least(75, 64, 10**9) == near_dedup.sampled_least(75)


def test_large_sets_at_the_limit_pass_the_filter(spark):
    """Of sketches that share 27 to 34 values none is ruled out (34 values were 4 standard errors)."""
    assert near_dedup.sampled_least(75) == 27
    left, right = list(range(64)), list(range(30)) + list(range(64, 98))
    flip = lambda values: [v - (1 << 63) + 0 if v >= 1 << 63 else v for v in values]
    schema = "class long, _n long, _sketch array<long>"
    classes = spark.createDataFrame([(1, 1000, flip(left)), (2, 1000, flip(right))], schema)
    pairs = spark.createDataFrame([(1, 2)], "a long, b long")
    assert near_dedup.estimated(pairs, classes, 75).count() == 1
