"""Joins against lookup tables: by regular expression and by key."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.patterns import CAPITALS, required_literals
from postlens.operators.pattern_index import CHUNK, LITERALS, indexed_pattern_join
from postlens.session import materialise

GROUP_SIZE = 16  # patterns tested together first; measured best between 8 and 21

#: What keeps its meaning only on its own: references to groups, named groups, quoting, comments.
_STANDS_ALONE = re.compile(r"\\[1-9kQE]|\(\?(?!:|=|!|<=|<!|>|[idmsuU]+[:)])")


def regex_lookup(df: DataFrame, text: Column, rows: Iterable[Sequence[str]], names: Sequence[str]) -> DataFrame:
    """Left join `text rlike pattern`: one output row per matching pattern, one with NULLs when none matches.

    `rows` are (pattern, value...) with values named `names`. The patterns become literals of one projection,
    so nothing is shuffled or broadcast and each pattern is compiled once per task. A pattern is tried only on texts that
    hold one of the literals it asks for (`functions.patterns`), a group of such patterns only on texts that hold one of
    theirs: looking for a few letters costs a small part of a regular expression. Patterns that ask for no literal and mean
    the same inside a larger one are tested in groups first (any of the group's patterns), then one by one inside the groups
    that matched; all others (with references, named groups, quoting or comments) are tested one by one at once.
    """
    rows = [(tuple(row), required_literals(row[0])) for row in rows]
    screened = [(row, needs) for row, needs in rows if needs]
    open_ = [(row, needs) for row, needs in rows if not needs]
    alone = [row for row in open_ if _STANDS_ALONE.search(row[0][0])]
    plain = [row for row in open_ if not _STANDS_ALONE.search(row[0][0])]
    hits = [_hits(alone, names)] if alone else []
    for at in range(0, len(screened), GROUP_SIZE):
        group = screened[at : at + GROUP_SIZE]
        hits.append(f"CASE WHEN {_holds({w for _, needs in group for w in needs})} THEN {_hits(group, names)} END")
    for at in range(0, len(plain), GROUP_SIZE):
        group = plain[at : at + GROUP_SIZE]
        anyof = _quoted("|".join(f"(?:{pattern})" for (pattern, *_), _ in group))
        hits.append(f"CASE WHEN _text RLIKE {anyof} THEN {_hits(group, names)} END")
    found = F.explode_outer(F.expr(f"flatten(array_compact(array({', '.join(hits)})))")).alias("_hit")
    folded = F.translate("_text", CAPITALS, CAPITALS.lower())
    matched = df.withColumn("_text", text).withColumn("_small", folded).select(*df.columns, found)
    return matched.select(*df.columns, *[F.col("_hit")[n].alias(n) for n in names])


def _holds(literals: Iterable[str]) -> str:
    """SQL condition that a folded text holds one of some literals; one that holds another needs no look of its own."""
    few = [w for w in sorted(set(literals)) if not any(other != w and other in w for other in literals)]
    return "(" + " OR ".join(f"contains(_small, {_quoted(w)})" for w in few) + ")"


def _hits(rows: list[tuple[Sequence[str], list[str] | None]], names: Sequence[str]) -> str:
    """SQL array of the values whose pattern matches."""
    fields = lambda values: ", ".join(f"{_quoted(v)} AS `{n}`" for v, n in zip(values, names))
    asked = lambda p, needs: f"{_holds(needs)} AND _text RLIKE {_quoted(p)}" if needs else f"_text RLIKE {_quoted(p)}"
    cases = [f"CASE WHEN {asked(p, needs)} THEN struct({fields(v)}) END" for (p, *v), needs in rows]
    return f"array_compact(array({', '.join(cases)}))"


def _quoted(value: str) -> str:
    """A SQL string literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def pattern_join(
    df: DataFrame, text: Column, patterns: DataFrame, pattern: str, names: Sequence[str], literals: int = LITERALS, chunk: int = CHUNK
) -> DataFrame:
    """`regex_lookup` against a table of patterns; a NULL pattern matches nothing.

    Up to `literals` patterns become literals of the plan; a longer table is joined through an index of the literals
    that its patterns need (`pattern_index`), `chunk` patterns at a time. The rows are the same.
    """
    wanted = patterns.select(F.col(pattern).alias("_pattern"), *names).filter("_pattern IS NOT NULL")
    rows = wanted.limit(literals + 1).collect()
    if rows and len(rows) <= literals:
        return regex_lookup(df, text, [tuple(r) for r in rows], names)
    return indexed_pattern_join(df, text, wanted, names, chunk, literals)


def _values(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """(_which, _key) of the distinct values of text columns, found in one pass over each frame; written."""
    found = []
    for df in frames:
        if len(columns) == 1:
            pairs = df.select(F.lit(0).alias("_which"), F.col(columns[0]).alias("_key"))
        else:
            pairs = F.array(*[F.struct(F.lit(i).alias("_which"), F.col(c).alias("_key")) for i, c in enumerate(columns)])
            pairs = df.select(F.inline(pairs))
        found.append(pairs)
    return materialise(reduce(DataFrame.unionAll, found).distinct(), "values")


def _one_column(values: DataFrame, which: int, column: str) -> DataFrame:
    """(_key, column) of one column's values."""
    return values.filter(F.col("_which") == which).select("_key", F.col("_key").alias(column))


def per_value(df: DataFrame, made: Mapping[str, Mapping[str, Callable[[str], Column]]]) -> DataFrame:
    """Columns made of one text column each, worked out once for each of its distinct values instead of once a row.

    `made` names for a text column the columns to make of it, by functions of its name; columns of `df` with such a name
    are replaced. The values of all columns are found in one pass over `df` and written, so Spark knows their size: few
    are broadcast, many joined by a shuffle. Meant for short texts that repeat and that cost more than a join with few
    rows, not for free text.
    """
    values = _values([df], list(made))
    for i, (c, functions) in enumerate(made.items()):
        looked_up = _one_column(values, i, c).select(F.col("_key").alias("_made_of"), *[f(c).alias(n) for n, f in functions.items()])
        kept = [F.col(f"`{n}`") for n in df.columns if n not in functions]
        df = df.select(*kept, F.col(c).alias("_key"))
        df = df.join(looked_up, F.col("_key").eqNullSafe(F.col("_made_of")), "left").drop("_key", "_made_of")
    return df


def rows_per_value(
    df: DataFrame, column: str, step: Callable[[DataFrame], DataFrame], found_in: Sequence[DataFrame] | None = None
) -> DataFrame:
    """What `step` makes of one text column, worked out once for each distinct value: any number of rows for each.

    `step` gets a frame with the column and `_key`, which it has to keep; the columns that it returns replace those of
    `df`, and rows whose value it gives no row for are dropped. `found_in` are frames that hold all values of `df`, if
    they are cheaper to read than `df` itself.
    """
    made = step(_one_column(_values([df] if found_in is None else found_in, [column]), 0, column))
    kept = [F.col(f"`{n}`") for n in df.columns if n not in made.columns]
    held = df.select(*kept, F.col(column).alias("_held"))
    return held.join(made, F.col("_held").eqNullSafe(F.col("_key"))).drop("_held", "_key")


def lookup_join(df: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left join to a lookup with unique keys.

    Rows without a key match nothing and take no part in the join, so they meet in no task. Spark broadcasts the
    lookup while its measured size is below `spark.sql.autoBroadcastJoinThreshold`; beyond that adaptive execution
    splits the partitions of hot keys.
    """
    others = [F.lit(None).cast(f.dataType).alias(f.name) for f in lookup.schema.fields if f.name != key]
    joined = df.filter(F.col(key).isNotNull()).join(lookup, key, "left")
    keyless = df.filter(F.col(key).isNull()).select(*df.columns, *others)
    return joined.select(*keyless.columns).unionByName(keyless)
