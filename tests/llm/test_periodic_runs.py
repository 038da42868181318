import hashlib
import random
import re
import zlib

import pytest

from postlens.llm.catalog import QUERIES
from postlens.llm.periodic_runs import periodic_runs, z_function


def brute_runs(words):
    """Every maximal stretch of each period from small to large; one that a smaller period has is not counted again."""
    out, seen = [], set()
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and j > i and (i, j + q) not in seen:
                seen.add((i, j + q))
                out.append((i, q, j + q - i))
            i = max(j, i + 1)
    return sorted(out)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def collapsed(words, runs):
    gone = {k for s, q, n in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def text(rng):
    kind, n = rng.randrange(5), rng.randrange(0, 160)
    if kind == 0:
        words = [rng.randrange(2) for _ in range(n)]
    elif kind == 1:
        words = [0] * n
    elif kind == 2:  # two words in an order without squares of squares
        words = [bin(k).count("1") % 2 for k in range(n)]
    elif kind == 3:
        cycle = [rng.randrange(50) for _ in range(rng.randrange(1, 30))]
        words = [rng.randrange(9) for _ in range(rng.randrange(9))] + (cycle * 20)[:n] + [rng.randrange(9) for _ in range(9)]
    else:
        words = []
        while len(words) < n:
            cycle = [rng.randrange(4) for _ in range(rng.randrange(1, 12))]
            words += (cycle * 8)[: rng.randrange(1, 8 * len(cycle) + 1)]
    return rng.choice([" ", "\n", " \t"]).join(f"w{k}" if k % 3 else f"é{k}" for k in words) + rng.choice(["", " "])


@pytest.mark.parametrize("tile", [4, 16, 64, 1 << 14])
def test_runs_against_brute_force(spark, tile):
    rng = random.Random(12)
    docs = [(k, text(rng)) for k in range(220)] + [(500, None), (501, ""), (502, " \n\x0b"), (None, "a " * 9), (7, "x"), (7, "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = periodic_runs(frame, tile=tile).collect()
    found = sorted((str(r.doc_id), r.text or "", r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in rows)
    expected = []
    for i, t in docs:
        words = split(t)
        runs = brute_runs(words)
        expected.append((str(i), t or "", len(words), runs, collapsed(words, runs)))
    assert found == sorted(expected)


def test_clashing_columns_digest_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b " * 5, 9, "x")], "id long, body string, runs int, _row string")
    (row,) = periodic_runs(docs, "body", digest=True).collect()
    assert row.asDict(recursive=True) == {
        "id": 1, "body": "a b " * 5, "n_words": 10, "runs": [{"start": 0, "period": 2, "length": 10}],
        "collapsed": hashlib.sha256(b"a b").hexdigest(),
    }
    assert periodic_runs(docs.limit(0), "body").collect() == []


def test_very_long_text(spark):
    """Above one slice of 2 MB and above one tile, with a period of 60,000 words and one of 3 across a tile's edge."""
    rng = random.Random(4)
    cycle = [f"cycle{rng.randrange(10**6)}" for _ in range(60_000)]
    words = ["start"] + cycle * 4 + ["turn"] + ["x", "y", "z"] * 7000 + ["end"]
    body = " ".join(words)
    assert len(body) > 2 << 20
    rows = {r.doc_id: r for r in periodic_runs(spark.createDataFrame([(1, body), (2, "a b c")], "doc_id long, text string")).collect()}
    assert [tuple(r) for r in rows[1].runs] == [(1, 60_000, 240_000), (240_002, 3, 21_000)] and rows[2].runs == []
    assert rows[1].collapsed == " ".join(["start", *cycle, "turn", "x", "y", "z", "end"])


def test_query_by_its_contract(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, sf).collect()}
    assert len(rows) == len(docs)
    planted = 0
    for i, t in docs:
        words = split(t)
        h, n = zlib.crc32(str(i).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
        if n > 1500:  # the plain search is quadratic
            continue
        runs = brute_runs(words)
        planted += bool(runs)
        lines = "".join(f"{s},{length},{q}\n" for s, q, length in runs)
        best = max(runs, key=lambda r: (r[2], -r[0], -r[1]), default=None)
        r = rows[i]
        expected = (None,) * 4 if best is None else (best[0], best[2], best[1], 1000 * best[2] // best[1])
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *expected)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert planted > 5


def test_z_function():
    assert z_function([]) == [] and z_function([1]) == [1]
    assert z_function(list("aabaabaaa")) == [9, 1, 0, 5, 1, 0, 2, 2, 1]
