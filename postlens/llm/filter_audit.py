"""Audit of how filters interact: what each removes, and what it would remove at another place in the order.

Every row gets a mask of the filters it fails. Spark counts the masks of each part with partial sums, so a part with a
third of all rows is at most `2 ** filters` rows before the shuffle, and a part's diagram is built from these counts.

A diagram has a layer for each filter, in the present order; a node's two edges lead to what passes and what fails the
layer's filter, and its weight is the rows (and the marked rows among them) below it. Equal nodes of a layer are one.
Two neighbouring filters change places by a swap of their layers alone: `f = (x, (y, f00, f01), (y, f10, f11))` becomes
`(y, (x, f00, f10), (x, f01, f11))`, and the layers above and below stay. Plain changes reach all orders by such swaps,
one each. The path of passing edges from the root gives the steps of an order: what is below its k-th failing edge is
what the k-th filter removes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.session import materialise

FILTERS = ("A", "B", "C", "D", "E")
MOST_FILTERS = 7
WHITE_SPACE = " \t\n\x0b\x0c\r"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

Weight = tuple[int, ...]


def _sum(x: Weight, y: Weight) -> Weight:
    return tuple(a + b for a, b in zip(x, y))


class Diagram:
    """A count-weighted decision diagram over failure masks; bit i of a mask is set if filter i fails."""

    def __init__(self, filters: int, counts: dict[int, Weight]):
        width = len(next(iter(counts.values()))) if counts else 1
        self.order = list(range(filters))
        self.layers: list[list[tuple[int, int]]] = [[] for _ in range(filters)]
        self.weights: list[list[Weight]] = [[] for _ in range(filters + 1)]
        known: list[dict] = [{} for _ in range(filters + 1)]

        def node(level: int, mask: int) -> int:
            key = counts.get(mask, (0,) * width) if level == filters else (node(level + 1, mask), node(level + 1, mask | 1 << level))
            if key not in known[level]:
                known[level][key] = len(known[level])
                if level < filters:
                    self.layers[level].append(key)
                    below = self.weights[level + 1]
                    self.weights[level].append(_sum(below[key[0]], below[key[1]]))
                else:
                    self.weights[level].append(key)
            return known[level][key]

        node(0, 0)

    def swap(self, level: int) -> None:
        """Let the filters of layers `level` and `level + 1` change places; nodes of `level` keep their numbers."""
        lower, below = self.layers[level + 1], self.weights[level + 2]
        known: dict[tuple[int, int], int] = {}

        def node(passing: int, failing: int) -> int:
            return known.setdefault((passing, failing), len(known))

        upper = []
        for passing, failing in self.layers[level]:
            (f00, f01), (f10, f11) = lower[passing], lower[failing]
            upper.append((node(f00, f10), node(f01, f11)))
        self.layers[level], self.layers[level + 1] = upper, list(known)
        self.weights[level + 1] = [_sum(below[p], below[f]) for p, f in known]
        self.order[level : level + 2] = self.order[level + 1], self.order[level]

    def steps(self) -> list[tuple[int, Weight, Weight]]:
        """(filter, weight kept, weight removed) of each step of the present order: the all-pass path."""
        at, out = 0, []
        for level, number in enumerate(self.order):
            passing, failing = self.layers[level][at]
            below = self.weights[level + 1]
            out.append((number, below[passing], below[failing]))
            at = passing
        return out


def plain_changes(n: int) -> Iterator[int]:
    """Positions of the adjacent swaps that lead through all orders of n things, each once."""
    if n < 2:
        return
    down = True
    for outer in (*plain_changes(n - 1), None):
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        if outer is not None:
            yield outer + 1 if down else outer
        down = not down


def audit_part(filters: Sequence[str], counts: dict[int, Weight]) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique, shapley, lost marks) of every order and step; weights hold rows first."""
    diagram = Diagram(len(filters), counts)
    orders, failing, alone, total = [], {}, {}, dict.fromkeys(range(len(filters)), 0)
    for swap in (None, *plain_changes(len(filters))):
        if swap is not None:
            diagram.swap(swap)
        steps = diagram.steps()
        failing[steps[0][0]], alone[steps[-1][0]] = steps[0][2][0], steps[-1][2][0]  # as first filter all it fails, as last what fails no other
        for number, _, removed in steps:
            total[number] += removed[0]
        orders.append(("".join(filters[number] for number, *_ in steps), steps))
    return [
        (order, k, kept[0], removed[0], failing[number] - removed[0], alone[number], total[number], *removed[1:])
        for order, steps in orders
        for k, (number, kept, removed) in enumerate(steps, 1)
    ]


def audit_filters(flags: DataFrame, part: str, filters: Sequence[str] = FILTERS, marks: Sequence[str] = ()) -> DataFrame:
    """The effect of each filter at each place of each order, per part.

    `flags` has a column `part` (as text; NULL counts as ''), a boolean column per filter, true where the row fails
    (NULL: it passes), and boolean mark columns (NULL: no). Filter names are single letters. Returns part,
    filter_order, step, kept, removed, redundant, unique_fails, shapley and `<mark>_lost` for each mark, one row for
    each step of each order of each part that has rows, zeros included. An empty table gives an empty result; rows
    that repeat count each time; other columns are ignored.
    """
    if not 0 < len(filters) <= MOST_FILTERS or len(set(filters)) != len(filters) or any(len(f) != 1 for f in filters):
        raise ValueError(f"1 to {MOST_FILTERS} filters with different names of one letter are audited")
    failed = lambda name: F.coalesce(F.col(f"`{name}`"), F.lit(False)).cast("int")
    mask: Column = F.lit(0)
    for i, name in enumerate(filters):
        mask = mask + F.shiftleft(failed(name), i)
    counted = flags.groupBy(F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), mask.alias("mask")).agg(
        F.count("*").alias("w0"), *[F.sum(failed(m)).alias(f"w{i}") for i, m in enumerate(marks, 1)]
    )
    schema = T.StructType().add("part", "string").add("filter_order", "string").add("step", "integer")
    for name in ("kept", "removed", "redundant", "unique_fails", "shapley", *[f"{m}_lost" for m in marks]):
        schema.add(name, "long")
    names = [f.name for f in schema.fields]
    columns = [f"w{i}" for i in range(len(marks) + 1)]

    def audit(table: pa.Table) -> pa.Table:
        counts = dict(zip(table["mask"].to_pylist(), zip(*[table[c].to_pylist() for c in columns])))
        rows = audit_part(filters, counts)
        arrays = [pa.array([table["part"][0].as_py()] * len(rows), pa.string())]
        kinds = [pa.string(), pa.int32(), *[pa.int64()] * (len(names) - 3)]
        return pa.table([*arrays, *[pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]], names=names)

    return counted.groupBy("part").applyInArrow(audit, schema)


def quality_failures(text: Column) -> dict[str, Column]:
    """Filters A to D, true where a text fails: too short, too repetitive, too many capitals, odd signs."""
    trimmed = F.btrim(text, F.lit(WHITE_SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \t-\r]+"))
    capitals = F.char_length(text) - F.char_length(F.translate(text, _CAPITALS, ""))
    return {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * capitals > 5 * F.char_length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def document_failures(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, A to E, good, toxic): the failures of each row and the marks of its label.

    NULL texts count as empty. A: under 50 words. B: fewer than 65 distinct words in 100. C: more than 5 capitals A-Z
    in 100 code points. D: any of `#$%&*|`. E: a smaller id anywhere in the table has the identical text; of equal
    texts the smallest id passes, also in each of its repeated rows, and a row without an id never fails E. Rows
    without a label (or an id) have no marks; of several labels any mark counts.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{part_col}`").cast("string").alias("part"),
        F.unhex(F.sha2(text, 256)).alias("key"),
        *[c.alias(name) for name, c in quality_failures(text).items()],
    )
    marks = labels.groupBy(F.col(f"`{id_col}`").alias("id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    rows = materialise(rows.join(marks, "id", "left"), "audit-rows")
    smallest = rows.filter("id IS NOT NULL").groupBy("key").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    repeated = materialise(smallest.filter("n > 1").select("key", "least"), "audit-repeated")  # the join is then dealt on its own
    return rows.join(repeated, "key", "left").select(
        "part", "A", "B", "C", "D", F.coalesce(F.col("id") > F.col("least"), F.lit(False)).alias("E"), "good", "toxic"
    )

