import random
import re

import pytest

from postlens.llm.decontaminate import WindowSearch, drop_contaminated, find_contamination


def words_of(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def brute(docs, items, window):
    out = {}
    for i, text in docs:
        words, hit, names = words_of(text), set(), set()
        for item, passage in items:
            test = words_of(passage)
            size = min(window, len(test))
            for a in range(len(test) - size + 1 if size and item is not None else 0):
                for b in range(len(words) - size + 1):
                    if words[b : b + size] == test[a : a + size]:
                        hit.update(range(b, b + size))
                        names.add(str(item))
        out[i] = (len(words), len(hit), sorted(names))
    return out


def compare(spark, docs, items, window, **options):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    rows = find_contamination(frame, tests, window=window, **options).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.items) for r in rows} == brute(docs, items, window)
    for r in rows:
        assert r.contaminated == (r.n_hit > 0) and r.n_hit == sum(s.end - s.start for s in r.hit_spans)


@pytest.mark.parametrize("seed, block_bytes", [(1, 1 << 20), (2, 60), (3, 1 << 20)])
def test_random_texts(spark, seed, block_bytes):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice(["a", "B", "c1", "é"]) + rng.choice(["", "", "."]) for _ in range(n))
    docs = [(i, text(rng.choice([0, 1, 3, 40, 200]))) for i in range(25)]
    items = [(rng.randrange(8), text(rng.choice([0, 1, 2, 3, 4, 5, 9]))) for _ in range(12)] if seed < 3 else [(1, text(4))]
    compare(spark, docs, items, 4, block_bytes=block_bytes)


def test_odd_rows(spark):
    passage = "One two, THREE four five six seven eight nine ten eleven"
    docs = [(1, None), (2, ""), (3, "?!"), (4, passage.lower().replace(",", " ;")), (5, "x " * 30000 + passage + " y"), (6, "ten eleven"), (7, "é" + passage)]
    compare(spark, docs, [(1, passage), (2, None), (3, "!!"), (None, "ten eleven"), (1, "ten eleven")], 10)


def test_repeated_rows_clashes_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", "mine", 5), (1, "a b", "mine", 5)], "doc_id long, text string, items string, words int")
    tests = spark.createDataFrame([(9, "b")], "item_id long, text string")
    rows = find_contamination(docs, tests).collect()
    assert [(r.doc_id, r.words, r.n_hit, r["items"]) for r in rows] == [(1, 5, 1, ["9"])] * 2
    assert [r.contaminated for r in find_contamination(docs, tests.limit(0)).collect()] == [False, False]
    assert find_contamination(docs.limit(0), tests).collect() == []
    assert drop_contaminated(docs.select("doc_id", "text"), tests).collect() == []


def test_search_skips():
    search = WindowSearch({tuple(b"abcdefghij"[i : i + 1] for i in range(10)): {"x"}})
    assert search.longest_shift == 9
    words = [b"z"] * 50 + [b"abcdefghij"[i : i + 1] for i in range(10)]
    assert [s for s, _ in search.find(words)] == [50]
