import hashlib
import re

import pytest

from postlens.llm.catalog import QUERIES
from postlens.llm.secret_scan import BASE_RULES, RULES, Rule, redact, scan_secrets, trigram_query

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KEY = "AKIA" + "Z9" * 8


def base_spans(text):
    """Straight from the definition: find everything, then drop what is too short."""
    text = text or ""
    found = [("assign", m) for m in re.finditer(ASSIGN, text, re.I | re.A) if len(m[2]) >= 6]
    found += [("access", m) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    order = ["assign", "access", "hex"]
    return sorted((m.start(), order.index(k), k, m.end()) for k, m in found)


def all_spans(text):
    text = text or ""
    more = [
        (m.start(), rank, rule.kind, m.end())
        for rank, rule in enumerate(RULES)
        if rank >= len(BASE_RULES)
        for m in re.finditer(rule.pattern, text)
    ]
    return sorted(base_spans(text) + more)


TEXTS = [
    None,
    "",
    "nothing here",
    "PassWord: 'abcdef' token=abc secret=token: abcdefgh",
    "é😀 api_key = \"x1_y2.z3\" ApiKey=123456 passwd:\nabcdefg",
    f"AKIA AKIAAKIA{KEY} {KEY} {KEY.lower()} x{KEY[:19]}",
    "0123456789abcdef0123456789abcdef" * 2 + "g" + "a" * 24 + " " + "b" * 23,
    "secret=" + "a" * 30 + " ſecret=abcdefgh toKen=abcdefgh",
    "-----BEGIN RSA PRIVATE KEY-----\nghp_" + "a1" * 18 + " xoxb-1234567890-abc sk_live_" + "Zz" * 12,
    "token==token=token token::abcdef token = = abcdef " * 40,
    ("filler words " * 20000) + "token=lastone1 " + "c" * 40,
    "PassWord: 'abcdef' token=abc secret=token: abcdefgh",
]


def result_of(frame):
    return sorted((r.doc_id, [(s.start, s.rank, s.kind, s.end) for s in r.secrets]) for r in frame.collect())


def test_equals_definition(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    assert result_of(scan_secrets(docs)) == [(i, all_spans(t)) for i, t in enumerate(TEXTS)]


def test_query_on_whole_table(spark, sf="/root/testdata/sf0.01"):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op10_secret_scan"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = base_spans(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for a, _, k, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[2] == k for s in base) for k in ("assign", "access", "hex")]
        assert r.spans == ",".join(f"{k}:{a}:{b}" for a, _, k, b in all_spans(texts[r.doc_id]))


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert scan_secrets(empty).collect() == []
    odd = spark.createDataFrame([(None, "token=abcdef", "mine", 1)], "doc_id long, text string, secrets string, start int")
    (row,) = scan_secrets(odd).collect()
    assert row.doc_id is None and row.start == 1 and [s.kind for s in row.secrets] == ["assign"]


def test_rule_without_trigrams_scans_everything(spark):
    docs = spark.createDataFrame([(1, "a1"), (2, "zz")], "doc_id long, text string")
    assert result_of(scan_secrets(docs, [Rule("digit", "[0-9]")])) == [(1, [(1, 0, "digit", 2)]), (2, [])]


@pytest.mark.parametrize("rule", RULES)
def test_query_is_mandatory(rule):
    """Whatever matches holds the trigrams of every clause."""
    for text in TEXTS:
        for m in re.finditer(rule.pattern, text or "", re.A):
            low = m[0].lower()
            for clause in trigram_query(rule.pattern):
                assert any(all(t in low for t in wanted) for wanted in clause)


def test_queries_of_patterns():
    assert trigram_query("[0-9a-f]{24,}") == []
    assert trigram_query("abcd") == [frozenset({frozenset({"abc", "bcd"})})]
    assert trigram_query("(foo|quux)x?") == [frozenset({frozenset({"foo"}), frozenset({"quu", "uux"})})]
    assert trigram_query("(foo)*") == []
    assert trigram_query("(abc[0-9]+)+") == [frozenset({frozenset({"abc"})})]


def test_redact(spark):
    docs = spark.createDataFrame([(1, "é token=abcdef, x " + "a" * 24), (2, None), (3, "clean")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in redact(docs).collect()} == {1: "é [secret], x [secret]", 2: None, 3: "clean"}
