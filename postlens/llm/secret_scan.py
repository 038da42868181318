"""Secret scan: regular expressions verified only where a trigram index says that they can match.

Each rule's pattern is read once into a Boolean query over trigrams that any match must contain (of lower-cased text).
The index holds one posting (trigram, text key) for every trigram that some rule asks for; postings are intersected
per key as bit masks, and only texts that satisfy a rule's query are matched against it. A rule without a mandatory
trigram scans every text. All steps over documents are built-in functions.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import product
from re import _constants as sre
from re import _parser as sre_parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.frames import without


class Rule(NamedTuple):
    """A kind of secret: matches of `pattern` whose group `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: Fixed by the contract, in its order. Runs that fail a minimum length never shift later matches of these two
#: patterns, so for them the length is part of the pattern; an assignment that fails does use up its characters.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("payment", r"[sr]k_(live|test)_[0-9A-Za-z]{24,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES

#: At most so many strings are followed side by side while a pattern is read.
MAX_STRINGS = 24
_MASK_BITS = 60

#: A clause holds if one of its sets of trigrams is there whole; a query is a list of clauses that all must hold.
Clause = frozenset[frozenset[str]]


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _class_strings(members: Iterable) -> set[str] | None:
    out: set[str] = set()
    for kind, value in members:
        if kind is sre.LITERAL:
            out.add(chr(value))
        elif kind is sre.RANGE and value[1] - value[0] < MAX_STRINGS:
            out.update(map(chr, range(value[0], value[1] + 1)))
        else:
            return None
    return out


def _strings(node) -> set[str] | None:
    """All strings that a part of a pattern can match, or None if they are many or unknown."""
    kind, value = node
    if kind is sre.LITERAL:
        return {chr(value)}
    if kind is sre.IN:
        return _class_strings(value)
    if kind is sre.SUBPATTERN:
        return _all_strings(value[-1])
    if kind is sre.BRANCH:
        parts = [_all_strings(branch) for branch in value[1]]
        return None if None in parts else set().union(*parts)
    if kind in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[1] <= 4:
        inner = _all_strings(value[2])
        if inner is not None and len(inner) ** value[1] <= MAX_STRINGS:
            return {"".join(p) for n in range(value[0], value[1] + 1) for p in product(inner, repeat=n)}
    return None


def _all_strings(nodes) -> set[str] | None:
    out = {""}
    for node in nodes:
        more = _strings(node)
        if more is None or len(out) * len(more) > MAX_STRINGS:
            return None
        out = {a + b for a, b in product(out, more)}
    return out


def _clauses(nodes) -> list[Clause]:
    out: list[Clause] = []
    run = {""}

    def close() -> None:
        sets = {_trigrams(s.lower()) for s in run}
        if all(sets):
            out.append(frozenset(s for s in sets if not any(less < s for less in sets)))

    for node in nodes:
        more = _strings(node)
        if more is not None and len(run) * len(more) <= MAX_STRINGS:
            run = {a + b for a, b in product(run, more)}
            continue
        close()
        run = more if more is not None and len(more) <= MAX_STRINGS else {""}
        kind, value = node
        if more is None and kind is sre.SUBPATTERN:
            out += _clauses(value[-1])
        elif more is None and kind in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0]:
            out += _clauses(value[2])
    close()
    return out


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses over lower-cased trigrams that every match satisfies; empty if nothing is mandatory."""
    return list(dict.fromkeys(_clauses(sre_parser.parse(pattern))))


def postings(texts: DataFrame, key: str, text: str, trigrams: Sequence[str]) -> DataFrame:
    """Rows (key, position of the trigram in the list) for each listed trigram in each lower-cased text."""
    low = texts.select(key, F.lower(text).alias("_low"))
    there = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)]))
    return low.select(key, F.explode(there).alias("trigram"))


def _holds(clauses: list[Clause], place: dict[str, int]) -> Column:
    """Whether a key's masks satisfy a query."""
    every = F.lit(True)
    for clause in clauses:
        some = F.lit(False)
        for wanted in clause:
            masks: dict[int, int] = {}
            for trigram in wanted:
                word, bit = divmod(place[trigram], _MASK_BITS)
                masks[word] = masks.get(word, 0) | 1 << bit
            whole = F.lit(True)
            for word, mask in masks.items():
                whole = whole & (F.col(f"_mask{word}").bitwiseAND(F.lit(mask).cast("bigint")) == F.lit(mask).cast("bigint"))
            some = some | whole
        every = every & some
    return every


def candidates(texts: DataFrame, key: str, text: str, queries: dict[str, list[Clause]]) -> DataFrame:
    """Keys that satisfy at least one query, with a flag per query: the intersected postings."""
    trigrams = sorted({t for clauses in queries.values() for clause in clauses for wanted in clause for t in wanted})
    place = {t: i for i, t in enumerate(trigrams)}
    bit = F.expr(f"shiftleft(1L, cast(trigram % {_MASK_BITS} AS int))")
    masks = [
        F.bit_or(F.when(F.floor(F.col("trigram") / _MASK_BITS) == word, bit).otherwise(F.lit(0).cast("bigint"))).alias(f"_mask{word}")
        for word in range(len(trigrams) // _MASK_BITS + 1)
    ]
    found = postings(texts, key, text, trigrams).groupBy(key).agg(*masks)
    flags = {name: _holds(clauses, place) for name, clauses in queries.items()}
    flagged = found.select(key, *[flag.alias(name) for name, flag in flags.items()])
    return flagged.filter(" OR ".join(f"`{name}`" for name in queries))


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of a rule in code points: texts between the matches give the gaps, the matches their lengths."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    gaps = F.split(text, rule.pattern, -1)
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")

    def step(done, pair):
        start = done["at"] + F.char_length(pair["gap"])
        end = start + F.char_length(pair["match"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        size = F.char_length(F.regexp_extract(pair["match"], rule.pattern, rule.group) if rule.group else pair["match"])
        more = F.when(size >= rule.least, F.concat(done["spans"], F.array(span))).otherwise(done["spans"])
        return F.struct(end.alias("at"), more.alias("spans"))

    pairs = F.arrays_zip(F.slice(gaps, 1, F.size(matches)).alias("gap"), matches.alias("match"))
    walked = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda done: done["spans"])
    return F.when(F.rlike(text, F.lit(rule.pattern)), walked).otherwise(none)


def scan_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """`docs` with `secrets`: every match of every rule as (start, rank, kind, end), in this order.

    Offsets are code points, the end exclusive; of one rule matches are leftmost and do not overlap, those of two
    rules may. `rank` is the rule's place in `rules`. NULL and empty texts have no match; repeated rows each get
    theirs; an empty table stays empty. A column named `secrets` is replaced.
    """
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = {f"_may_{kind}": clauses for kind, clauses in queries.items() if clauses}
    base = without(docs, ("secrets",))
    names = base.columns
    keyed = base.withColumn("_scanned", F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    keyed = keyed.withColumn("_text_key", F.xxhash64("_scanned"))  # a clash only adds a candidate
    if indexed:
        keyed = keyed.join(candidates(keyed, "_text_key", "_scanned", indexed), "_text_key", "left")
    spans = []
    for rank, rule in enumerate(rules):
        found = _spans(F.col("_scanned"), rule, rank)
        none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
        spans.append(F.when(F.coalesce(F.col(f"_may_{rule.kind}"), F.lit(False)), found).otherwise(none) if f"_may_{rule.kind}" in indexed else found)
    return keyed.select(*[F.col(f"`{c}`") for c in names], F.array_sort(F.concat(*spans)).alias("secrets"))


def redact(docs: DataFrame, mask: str = "[secret]", rules: Sequence[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """`docs` with every match replaced by `mask`; overlapping matches are replaced by one."""
    found = scan_secrets(docs, rules, text_col)
    text = F.col(f"`{text_col}`")
    nothing = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))

    def step(done, span):
        kept = F.substring(text, done["at"] + 1, F.greatest(span["start"] - done["at"], F.lit(0)))
        put = F.when(span["start"] >= done["at"], F.lit(mask)).otherwise(F.lit(""))
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), F.concat(done["text"], kept, put).alias("text"))

    rest = F.aggregate("secrets", nothing, step, lambda done: F.concat(done["text"], F.substring(text, done["at"] + 1, F.char_length(text))))
    return found.withColumn(text_col, F.when(F.size("secrets") > 0, rest).otherwise(text)).drop("secrets")


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

