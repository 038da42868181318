import hashlib
import random
import re
from collections import Counter

import pytest

from postlens.llm.substring_dedup import remove_repeats


def brute(docs, window):
    lists = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    seen = Counter(tuple(w[i : i + window]) for w in lists for i in range(len(w) - window + 1))
    out = []
    for (i, _), words in zip(docs, lists):
        gone = set()
        for at in range(len(words) - window + 1):
            if seen[tuple(words[at : at + window])] > 1:
                gone.update(range(at, at + window))
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out, key=str)


def compare(spark, docs, window):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = remove_repeats(frame, window=window).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_removed, r.kept) for r in rows], key=str) == brute(docs, window)
    assert all(r.n_removed == sum(s.end - s.start for s in r.spans) for r in rows)


@pytest.mark.parametrize("seed, window", [(1, 4), (2, 8), (3, 12), (4, 1)])
def test_random_texts(spark, seed, window):
    rng = random.Random(seed)
    text = lambda n: [rng.choice("abcdefgh") for _ in range(n)]
    passages = [text(window * 3) for _ in range(4)]
    docs = []
    for i in range(40):
        words = text(rng.choice([0, window - 1, window, 5 * window]))
        for _ in range(rng.choice([0, 1, 2])):
            passage = rng.choice(passages)
            begin = rng.randrange(len(passage))
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage[begin : begin + rng.randrange(1, 3 * window)]
        docs.append((i, rng.choice([" ", "\n", "\x0b "]).join(words)))
    compare(spark, docs + docs[:3], window)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30000))
    docs = [(1, None), (2, ""), (3, " \t"), (4, "a " * 300), (5, long), (6, "x " + long), (7, "é É " * 40), (None, "b " * 34), (8, "b " * 34 + "c")]
    compare(spark, docs, 35)


def test_digest_clashes_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "a b", "mine", 4)], "doc_id long, text string, kept string, anchor int")
    (row,) = remove_repeats(frame, window=1, digest=True).collect()
    assert (row.kept, row.anchor, row.n_removed) == (hashlib.sha256(b"a b").hexdigest(), 4, 0)
    assert remove_repeats(frame.limit(0)).collect() == []
