"""Near-duplicate detection with bottom-k sketches from one hash function.

A document's set of word shingles is hashed once; its sketch keeps the `SKETCH` smallest hashes. Documents with equal
sets form a class first, so copies cost one row. Inverted lists over the retained values generate overlaps: two similar
sets share a known number of retained values (`least_shared`), so they share one of the rarest values of each, as many
as leave no room for that number in the others. A list is a value among the rarest ones of its members.

Every class is first paired with one leader, the one in the middle of its largest lists. What that links is one
component, and then pairs are made across components only. Lists of up to `LIST` classes hand out their pairs; those
that the union sketch rules out are dropped and the rest are confirmed on the full sets. Longer lists come in bundles
with nearly the same members (a group of near copies shares most of its values), so lists that share half of their
members with a larger one are merged into it, and a pair meets once instead of once a list. A merged list is dealt into
blocks of `BLOCK` classes; members of its largest component only meet the others, not each other. A task compares the
full sets of one pair of blocks and hands out links that join components, at most one less than it has members, so a
group of thousands of near copies costs a few rows a member and no list is cut.

What can be missed: nothing if the sets are small (up to about 110 shingles at a limit of 0.75, the number of shared
values is then certain); otherwise a pair at the limit with a probability below `MISS` = 1e-8 in all, since the keys,
the blocks and the filter ask for the same number of shared values of the union sketch. Sets beyond `WHOLE` shingles
meet in long lists by their `WHOLE` smallest values, with the same bound, and are confirmed on the full sets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.components import components
from postlens.llm.frames import slices, utf8, without
from postlens.llm.words import Words, mix, range_hashes, run_hashes, split_words
from postlens.session import materialise

SHINGLE, PERCENT = 5, 75
SKETCH, LIST, BLOCK, MISS = 64, 40, 1024, 1e-8
WHOLE = 1024  # shingles of a set that long lists compare exactly
RESULT = ("n_shingles", "component_id", "kept")
_SALT = np.uint64(0xA0761D6478BD642F)


def shingle_sets(words: Words, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle, one without words has none."""
    runs = run_hashes(words.hashes, size)
    out = []
    for first, last in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if last - first >= size:
            out.append(np.unique(runs[first : last - size + 1]))
        elif last > first:
            out.append(range_hashes(words.hashes, np.array([first]), np.array([last])))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def _signature(values: np.ndarray) -> tuple[int, int]:
    """Two sums over a set, the same for equal sets only (up to chance of 2**-128)."""
    sums = (int(mix(values).sum(dtype=np.uint64)), int(mix(values ^ _SALT).sum(dtype=np.uint64)))
    return tuple(s - (1 << 64) if s >= 1 << 63 else s for s in sums)


def sketches(docs: DataFrame, id_col: str, text_col: str, carry: Sequence[str]) -> DataFrame:
    """Carried columns, _id, n, sig_a, sig_b, sketch of each document; the sketch ascends (as unsigned numbers)."""
    kept = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{id_col}`").alias("_id"))
    rows = docs.select(*kept.columns[:-1], F.col(f"`{id_col}`").alias("_id"), utf8(F.col(f"`{text_col}`")).alias("_text"))
    schema = kept.schema.add("_n", "long").add("_sig_a", "long").add("_sig_b", "long").add("_sketch", T.ArrayType(T.LongType()))

    def sketch(batches):
        for batch in slices(batches, "_text"):
            sets = shingle_sets(split_words(batch["_text"], lower=True))
            signatures = [_signature(s) for s in sets]
            cut = [s[:SKETCH].view(np.int64) for s in sets]
            offsets = np.cumsum([0, *map(len, cut)])
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch[c] for c in (*carry, "_id")],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s[0] for s in signatures], pa.int64()),
                    pa.array([s[1] for s in signatures], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([*cut, np.zeros(0, np.int64)]), pa.int64())),
                ],
                names=[*carry, "_id", "_n", "_sig_a", "_sig_b", "_sketch"],
            )

    return rows.mapInArrow(sketch, schema)


def sampled_least(percent: int, sketch: int = SKETCH, union: int | None = None) -> int:
    """Number of the `sketch` smallest values of a union that similar sets share but for a probability below `MISS`.

    The values are a sample of the union, without return if its size is known (hypergeometric), else as if with return
    (binomial, whose lower tail is the larger one).
    """
    share, below, shared = percent / 100, 0.0, 0
    common = None if union is None else math.ceil(union * share)
    while shared < sketch:
        if union is None:
            below += math.comb(sketch, shared) * share**shared * (1 - share) ** (sketch - shared)
        else:
            below += math.comb(common, shared) * math.comb(union - common, sketch - shared) / math.comb(union, sketch)
        if below >= MISS:
            break
        shared += 1
    return shared


@lru_cache(maxsize=8)
def _least_by_size(percent: int) -> tuple[tuple[int, int], ...]:
    """(largest set size, shared values) steps for sets larger than their sketch; larger sets are bounded as if infinite."""
    steps: list[tuple[int, int]] = []
    final, least = sampled_least(percent), SKETCH
    for n in range(SKETCH + 1, 64 * SKETCH):
        # The union is largest, and the sample of it least certain, where one set holds the other.
        least = min(least, sampled_least(percent, SKETCH, n * 100 // percent))
        if least <= final:
            break
        if steps and steps[-1][1] == least:
            steps.pop()
        steps.append((n, least))
    return tuple(steps)


def least_shared(n: Column, percent: int) -> Column:
    """Number of retained values that a set of n shingles shares with any similar set.

    A set has ceil(percent * n) in common with it. Their union has n / percent values at most; those of it beyond the
    `SKETCH` smallest may all be common ones. Only for a set larger than its sketch chance has to be counted on.
    """
    common = F.ceil(n * percent / 100 - 1e-9)
    certain = SKETCH - F.floor(n * (100 - percent) / percent + 1e-9)
    sampled = F.lit(sampled_least(percent))
    for largest, least in reversed(_least_by_size(percent)):
        sampled = F.when(n <= largest, F.lit(least)).otherwise(sampled)
    return F.when(n <= SKETCH, F.least(common, certain)).otherwise(F.greatest(certain, sampled)).cast("int")


def inverted_lists(classes: DataFrame, percent: int) -> DataFrame:
    """(key, class, size, leader, weight): the members of every list of at least two classes, and the list's size.

    A list's leader is the member that shares most lists with others, counting members (its weight): of a group of near
    copies the one in the middle.
    """
    values = materialise(classes.select("class", F.explode("_sketch").alias("key")), "sketch-values")
    sizes = materialise(values.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "value-sizes")
    repeated = values.join(sizes, "key").groupBy("class").agg(F.array_sort(F.collect_list(F.struct("size", "key"))).alias("v"))
    kept = F.size("_sketch")
    # Of the rarest values, those in no other sketch come first and need no list.
    taken = kept - least_shared(F.col("_n"), percent) + 1 - (kept - F.size("v"))
    rarest = repeated.join(classes.select("class", "_n", "_sketch"), "class").filter(taken > 0)
    keys = materialise(rarest.select("class", F.explode(F.slice("v", 1, taken)["key"]).alias("key")), "sketch-keys")
    sizes = materialise(keys.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "list-sizes")
    members = materialise(keys.join(sizes, "key").select("key", "class", "size"), "list-members")
    shared = members.groupBy("class").agg(F.sum("size").alias("shared"))
    leaders = members.join(shared, "class").groupBy("key").agg(F.max(F.struct("shared", "class")).alias("l"))
    named = leaders.select("key", F.col("l.class").alias("leader"), F.col("l.shared").alias("weight"))
    return materialise(members.join(named, "key").select("key", "class", "size", "leader", "weight"), "lists")


def first_pairs(members: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of each class and the leader of most weight among its lists: one a class at most."""
    best = members.filter("class <> leader").groupBy("class").agg(F.max(F.struct("weight", "leader"))["leader"].alias("leader"))
    return best.select(F.least("leader", "class").alias("a"), F.greatest("leader", "class").alias("b")).distinct()


def _pair(one: Column, two: Column) -> Column:
    return F.struct(one["class"].alias("a"), two["class"].alias("b"), one["component"].alias("c_a"), two["component"].alias("c_b"))


def placed_between(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members, with their component by now, of the lists that have members of several components."""
    own = found.select(F.col("node").alias("class"), "component")
    placed = members.drop("component").join(own, "class", "left").select(
        "key", "class", "size", "leader", F.coalesce("component", "class").alias("component")
    )
    placed = materialise(placed, "placed")
    several = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y")
    return materialise(placed.join(several.select("key"), "key"), "lists-between")


def merged_lists(placed: DataFrame) -> DataFrame:
    """(key, class, component): long lists, those that have half of their members in common with a larger one merged into it.

    Each class names its largest list; a list goes to the one that most of its members name. Every pair of members of a
    list is in the list that it went to.
    """
    home = placed.groupBy("class").agg(F.max(F.struct("size", "key"))["key"].alias("home"))
    votes = placed.join(home, "class").groupBy("key", "home").agg(F.count("*").alias("n"))
    chosen = votes.groupBy("key").agg(F.max(F.struct("n", "home")).alias("most"), F.sum("n").alias("size"))
    goes_to = F.when(F.col("most.n") * 2 >= F.col("size"), F.col("most.home")).otherwise(F.col("key"))
    chosen = materialise(chosen.select("key", goes_to.alias("to")), "merged-keys")
    return materialise(placed.join(chosen, "key").select(F.col("to").alias("key"), "class", "component").distinct(), "merged-lists")


def dealt_blocks(merged: DataFrame) -> DataFrame:
    """(key, i, j, own, class, component): members of merged lists in the pairs of blocks that have to meet.

    Blocks 0 .. r - 1 hold the members outside the list's largest component, the others those inside. A block of the
    former meets itself and every other block (i >= j, j < r).
    """
    counts = merged.groupBy("key", "component").agg(F.count("*").alias("n"))
    largest = counts.groupBy("key").agg(F.max(F.struct("n", "component")).alias("l"), F.sum("n").alias("n"))
    blocks = largest.select(
        "key",
        F.col("l.component").alias("_main"),
        F.ceil((F.col("n") - F.col("l.n")) / BLOCK).cast("int").alias("_r"),
        F.ceil(F.col("l.n") / BLOCK).cast("int").alias("_m"),
    ).filter("_r > 0")
    rows = merged.join(materialise(blocks, "block-counts"), "key")
    part = lambda n: F.pmod(F.xxhash64("key", "class"), n).cast("int")
    inside = F.col("component") == F.col("_main")
    rows = rows.withColumn("own", F.when(inside, F.col("_r") + part(F.col("_m"))).otherwise(part(F.col("_r"))))
    pair = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    as_second = F.transform(F.sequence(F.lit(0), F.least(F.col("own"), F.col("_r")) - 1), lambda j: pair(F.col("own"), j))
    as_first = F.transform(F.sequence(F.col("own"), F.col("_r") + F.col("_m") - 1), lambda i: pair(i, F.col("own")))
    met = F.when(F.col("own") == 0, as_first).when(inside, as_second).otherwise(F.concat(as_second, as_first))
    return rows.select("key", F.explode(met).alias("p"), "own", "class", "component").select("key", "p.i", "p.j", "own", "class", "component")


def wide_sets(texts: DataFrame) -> DataFrame:
    """(class, n, values): the `WHOLE` smallest shingle hashes of each class, as bytes, and the size of its set."""

    def cut(batches):
        for batch in slices(batches, "text"):
            sets = shingle_sets(split_words(batch["text"], lower=True))
            columns = [batch["class"], pa.array([len(s) for s in sets], pa.int64()), pa.array([s[:WHOLE].tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["class", "n", "values"])

    return texts.mapInArrow(cut, "class long, n long, values binary")


def _shared_counts(sets: list[np.ndarray], first: np.ndarray) -> np.ndarray:
    """Number of values that each of the sets named by `first` shares with every set."""
    counts = [len(s) for s in sets]
    values, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), counts)
    twice = seen[column] > 1
    row, column = row[twice], (np.cumsum(seen > 1) - 1)[column[twice]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((len(first), len(sets)), dtype=np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, 2048):
        low, high = np.searchsorted(column, [start, start + 2048])
        held = np.zeros((len(sets), 2048), dtype=np.float32)
        held[row[low:high], column[low:high] - start] = 1
        shared += held[first] @ held.T
    return shared


def _joining(left: np.ndarray, right: np.ndarray) -> list[int]:
    """Of links between components the positions of those that join what earlier ones have not."""
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while root.get(c, c) != c:
            root[c] = root.get(root[c], root[c])
            c = root[c]
        return c

    out = []
    _, places = np.unique(np.stack([left, right], axis=1), axis=0, return_index=True)
    for place in np.sort(places).tolist():
        x, y = find(int(left[place])), find(int(right[place]))
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append(place)
    return out


def compared_blocks(dealt: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, c_a, c_b, estimate, sure): links across components, and pairs of large sets that may be links (not `sure`)."""
    rows = dealt.join(sets, "class")
    enough = sampled_least(percent, WHOLE)

    def compare(table: pa.Table) -> pa.Table:
        own, node, component, n = (table[c].to_numpy() for c in ("own", "class", "component", "n"))
        second = table["j"][0].as_py()
        values = [np.frombuffer(v, dtype=np.uint64) for v in table["values"].to_pylist()]
        first = np.flatnonzero(own == second)
        out: dict[str, list] = {c: [] for c in ("a", "b", "c_a", "c_b", "estimate", "sure")}
        for start in range(0, len(first), 512):
            part = first[start : start + 512]
            shared = _shared_counts(values, part)
            whole = (n[part] <= WHOLE)[:, None] & (n <= WHOLE)[None, :]
            link = (shared > 0) & (100 * shared >= percent * (n[part][:, None] + n[None, :] - shared)) & whole
            maybe = (shared >= enough) & ~whole & (100 * np.minimum(n[part][:, None], n[None, :]) >= percent * np.maximum(n[part][:, None], n[None, :]))
            apart = component[part][:, None] != component[None, :]
            for kind, sure in ((link, True), (maybe, False)):
                x, y = np.nonzero(kind & apart)
                x = part[x]
                if sure and len(x):
                    kept = _joining(np.minimum(component[x], component[y]), np.maximum(component[x], component[y]))
                    x, y = x[kept], y[kept]
                else:
                    once = (own[y] != second) | (node[x] < node[y])
                    x, y = x[once], y[once]
                turned = node[x] > node[y]
                low, high = np.where(turned, y, x), np.where(turned, x, y)
                out["a"] += node[low].tolist()
                out["b"] += node[high].tolist()
                out["c_a"] += component[low].tolist()
                out["c_b"] += component[high].tolist()
                out["estimate"] += [1.0] * len(low) if sure else (shared[np.searchsorted(part, x), y] / WHOLE).tolist()
                out["sure"] += [sure] * len(low)
        kinds = {"estimate": pa.float64(), "sure": pa.bool_()}
        return pa.table({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()})

    schema = "a long, b long, c_a long, c_b long, estimate double, sure boolean"
    return rows.groupBy("key", "i", "j").applyInArrow(compare, schema)


def _pairs_of_short(placed: DataFrame) -> DataFrame:
    lists = placed.groupBy("key").agg(
        F.array_sort(F.collect_set(F.struct("class", "component"))).alias("c"), F.min("component").alias("x"), F.max("component").alias("y")
    )

    def with_later(one, at):
        others = F.filter(F.slice(F.col("c"), at + 2, F.size("c")), lambda two: two["component"] != one["component"])
        return F.transform(others, lambda two: _pair(one, two))

    return lists.filter("x <> y").select(F.inline(F.flatten(F.transform("c", with_later))))


def estimated(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs that the union sketch does not rule out, with the similarity estimated from it."""
    # Flipping the sign bit makes signed order the order of unsigned numbers, in which the smallest were kept.
    small = F.transform("_sketch", lambda v: v.bitwiseXOR(F.lit(-(1 << 63)).cast("bigint")))
    side = lambda name: classes.select(F.col("class").alias(name), F.col("_n").alias(f"n_{name}"), small.alias(f"s_{name}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, SKETCH)
    shared, of = F.size(F.array_intersect(F.array_intersect("s_a", "s_b"), union)), F.size(union)
    # A union of fewer values is whole, and so are both sets.
    least = F.when(of < SKETCH, of * percent / 100 - 1e-9).otherwise(F.lit(sampled_least(percent)))
    return both.filter(sizes).filter(shared >= least).select(*pairs.columns, (shared / of).alias("estimate"))


def _texts_of(docs: DataFrame, classes: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(class, text) of the wanted classes: the text of a document with the class's smallest id and its set."""
    known = classes.join(wanted, "class", "left_semi").select("class", F.col("id").alias("_id"), "_sig_a", "_sig_b")
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), utf8(F.col(f"`{text_col}`")).alias("text"))
    found = rows.join(known, rows["_id"].eqNullSafe(known["_id"])).select("class", "_sig_a", "_sig_b", "text")

    def same(batches):
        for batch in slices(batches, "text"):
            sets = shingle_sets(split_words(batch["text"], lower=True))
            own = [_signature(s) for s in sets]
            keep = [o == s for o, s in zip(own, zip(batch["_sig_a"].to_pylist(), batch["_sig_b"].to_pylist()))]
            yield batch.select(["class", "text"]).filter(pa.array(keep, pa.bool_()))

    return found.mapInArrow(same, "class long, text binary").groupBy("class").agg(F.first("text").alias("text"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs, with what they carry, whose full shingle sets are similar enough."""
    carried = pairs.columns
    side = lambda name: texts.select(F.col("class").alias(name), F.col("text").alias(f"t_{name}"))

    def confirm(batches):
        for batch in slices(slices(batches, "t_a"), "t_b"):
            left = shingle_sets(split_words(batch["t_a"], lower=True))
            right = shingle_sets(split_words(batch["t_b"], lower=True))
            keep = []
            for x, y in zip(left, right):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(carried).filter(pa.array(keep, pa.bool_()))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(confirm, pairs.schema)


def _between(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs of different components, with both components as c_a and c_b."""
    side = lambda name: found.select(F.col("node").alias(name), F.col("component").alias(f"c_{name}"))
    both = pairs.select("a", "b").join(side("a"), "a", "left").join(side("b"), "b", "left")
    both = both.withColumns({"c_a": F.coalesce("c_a", "a"), "c_b": F.coalesce("c_b", "b")})
    return both.filter("c_a <> c_b")


def joined_components(found: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) after links between components (c_a, c_b); a class in no component so far is its own."""
    merged = components(links.select(F.col("c_a").alias("a"), F.col("c_b").alias("b")))
    merged = merged.select(F.col("node").alias("component"), F.col("component").alias("to"))
    known = found.join(merged, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    single = merged.join(found.select(F.col("node").alias("component")), "component", "left_anti")
    return materialise(known.union(single.select("component", "to")), "components")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, carry: Sequence[str] | None = None
) -> DataFrame:
    """Every row of `docs` with its set size and its component of documents linked by shingle similarity.

    Two documents are linked if 100 * |A and B| >= percent * |A or B| for their sets of word shingles (A-Z folded).
    Adds `n_shingles`, `component_id` (the smallest id reachable, its own included; NULL counts as largest) and `kept`
    (the id is that smallest one; rows that repeat an id and its text all keep it). NULL, empty and wordless texts
    are linked with nothing. An empty table stays empty. Columns that clash with a result column are replaced;
    `carry` names the columns to return besides the id (default: all).
    """
    names = [c for c in without(docs, RESULT).columns if carry is None or c in (*carry, id_col)]
    sketched = materialise(sketches(docs, id_col, text_col, names), "sketches")
    own = ["_n", "_sig_a", "_sig_b"]
    classes = sketched.filter("_n > 0").groupBy(*own).agg(F.min("_id").alias("id"), F.first("_sketch").alias("_sketch"))
    classes = materialise(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    members = inverted_lists(classes, percent)
    pairs = materialise(estimated(first_pairs(members), classes, percent), "led")
    texts = materialise(_texts_of(docs, classes, _ends(pairs), id_col, text_col), "texts")
    found = materialise(components(confirmed(pairs.select("a", "b"), texts, percent)), "components")

    members = placed_between(members, found)
    merged = merged_lists(members.filter(F.col("size") > LIST))
    crowded = materialise(_texts_of(docs, classes, merged.select("class").distinct(), id_col, text_col), "texts")
    compared = materialise(compared_blocks(dealt_blocks(merged), materialise(wide_sets(crowded), "wide-sets"), percent), "compared")
    found = joined_components(found, compared.filter("sure"))

    short = estimated(_pairs_of_short(members.filter(F.col("size") <= LIST)).distinct(), classes, percent)
    left = short.unionByName(compared.filter("NOT sure").drop("sure")).select("a", "b")
    left = materialise(_between(left, found), "left")
    wanted = _ends(left).join(texts, "class", "left_anti")
    texts = texts.union(materialise(_texts_of(docs, classes, wanted, id_col, text_col), "texts"))
    found = joined_components(found, materialise(confirmed(left, texts, percent), "links"))
    smallest = classes.join(found, classes["class"] == found["node"], "left").select(
        *own, "id", F.coalesce("component", "class").alias("component")
    )
    of_component = smallest.groupBy("component").agg(F.min("id").alias("component_id"))
    labels = materialise(smallest.join(of_component, "component").select(*own, "component_id"), "labels")
    component = F.when(F.col("_n") > 0, F.col("component_id")).otherwise(F.col("_id"))
    return sketched.join(labels, own, "left").select(
        *[F.col(f"`{c}`") for c in names],
        F.col("_n").alias("n_shingles"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("_id")).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One document of each component, with its columns: the one with the smallest id, and of rows that repeat an id one.

    Rows without an id are kept as they are, since nothing tells them from each other.
    """
    kept = near_duplicates(docs, id_col, text_col, percent, carry=()).filter("kept").select(F.col(f"`{id_col}`").alias("_kept")).distinct()
    named = docs.filter(F.col(f"`{id_col}`").isNotNull())
    mine = named.join(kept, named[id_col] == kept["_kept"], "left_semi")
    return mine.dropDuplicates([id_col]).unionByName(docs.filter(F.col(f"`{id_col}`").isNull()))
