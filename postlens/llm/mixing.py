"""Mixing sources to target weights by Poisson replication.

A source's rate is the mean number of times one of its documents is repeated so that the sources' shares become the
target shares. Each document's count inverts the Poisson distribution of its rate at a number between 0 and 1 that is
hashed from a seed and its id, so a rerun, or a lost executor, gives the same counts. Documents are exploded by their
counts and shuffled by a hash of seed, id and replica. All of it is built-in functions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.frames import without
from postlens.session import materialise

TEMPERATURE, EPOCHS, SEED = 0.7, 1.0, 20240607
#: Sources whose rates are broadcast to the documents; more of them are joined by a shuffle.
FEW_SOURCES = 5_000
#: A larger rate is drawn as a sum of several draws, since exp(-rate) would vanish.
LARGEST_DRAW = 256.0
RESULT = ("replica", "shuffle_key")


def uniform(seed: int, *parts: Column) -> Column:
    """A number in [0, 1), a multiple of 2**-52, hashed from seed and parts."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double") / float(1 << 52)


def poisson_steps(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1), .. as far as they differ from 1, for a rate up to LARGEST_DRAW."""
    most = F.ceil(rate + 10 * F.sqrt(rate) + 20).cast("int")
    none = F.exp(-rate)
    start = F.struct(none.alias("p"), none.alias("total"), F.array(none).alias("steps"))

    def step(done, k):
        p = done["p"] * rate / k
        total = done["total"] + p
        return F.struct(p.alias("p"), total.alias("total"), F.concat(done["steps"], F.array(total)).alias("steps"))

    return F.aggregate(F.sequence(F.lit(1), most), start, step, lambda done: done["steps"])


def source_rates(
    docs: DataFrame, source_col: str = "source", weights: DataFrame | None = None, temperature: float = TEMPERATURE, epochs: float = EPOCHS
) -> DataFrame:
    """(source, documents, rate): the mean repetition of each source's documents.

    `weights` has columns source and weight (not negative; sources not listed get 0). Without it a source weighs
    documents ** temperature. `epochs` is the mean repetition over all documents.
    """
    sizes = docs.groupBy(F.col(f"`{source_col}`").alias("source")).agg(F.count("*").alias("documents"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow(F.col("documents").cast("double"), F.lit(temperature)))
    else:
        listed = weights.select(F.col("source").alias("_s"), F.col("weight").cast("double").alias("weight"))
        weighed = sizes.join(listed, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s").fillna(0.0, ["weight"])
    totals = weighed.agg(F.sum("weight"), F.sum("documents")).first()
    scale = epochs * (totals[1] or 0) / totals[0] if totals[0] else 0.0
    return weighed.select("source", "documents", (F.col("weight") * F.lit(float(scale)) / F.col("documents")).alias("rate"))


def mix_sources(
    docs: DataFrame,
    rates: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    seed: int = SEED,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """`docs` repeated to the rates and shuffled: one row for each replica, ordered by `shuffle_key`.

    Adds `replica` (from 1) and `shuffle_key`. A document with no draw goes; one without a source has the rate of the
    NULL source; rows that repeat an id (or have none) share their draw. An empty table stays empty. Columns that
    clash with a result column are replaced; `carry` names the columns to return besides (default: all).
    """
    names = [c for c in without(docs, RESULT).columns if carry is None or c in carry]
    parts = F.greatest(F.ceil(F.col("rate") / LARGEST_DRAW), F.lit(1)).cast("int")
    steps = rates.select(F.col("source").alias("_source"), parts.alias("_parts"), poisson_steps(F.col("rate") / parts).alias("_steps"))
    steps = materialise(steps, "rates")
    if steps.count() <= FEW_SOURCES:
        steps = F.broadcast(steps)
    source, name = F.col(f"`{source_col}`"), F.col(f"`{id_col}`")
    joined = docs.select(*[F.col(f"`{c}`") for c in names], name.alias("_id"), source.alias("_of")).join(
        steps, F.col("_of").eqNullSafe(F.col("_source"))
    )
    draws = F.transform(
        F.sequence(F.lit(1), F.col("_parts")),
        lambda part: F.struct(uniform(seed, F.col("_id"), part).alias("u")),
    )
    counted = joined.withColumn("_draws", draws)
    count = F.aggregate(
        "_draws", F.lit(0), lambda total, draw: total + F.size(F.filter("_steps", lambda p: p <= draw["u"]))
    )
    repeated = counted.withColumn("_count", count).filter("_count > 0")
    replicas = repeated.select(*[F.col(f"`{c}`") for c in names], "_id", F.explode(F.sequence(F.lit(1), F.col("_count"))).alias("replica"))
    key = F.xxhash64(F.lit(seed), "_id", "replica")
    return replicas.withColumn("shuffle_key", key).drop("_id").orderBy("shuffle_key")


def expected_documents(rate: float, documents: int) -> tuple[float, float]:
    """Mean and standard deviation of the rows that a source contributes."""
    return rate * documents, math.sqrt(rate * documents)
