"""From raw documents to training-order token shards, in five stages over whole tables.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
stage's documents. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.crf_language import UNDETERMINED, identify_languages, train_field, training_pieces
from postlens.llm.decontaminate import drop_contaminated
from postlens.llm.mixing import mix_sources, source_rates
from postlens.llm.near_dedup import drop_near_duplicates
from postlens.llm.token_shards import materialise_order
from postlens.session import materialise


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with words in languages that the labels teach, mixtures included; texts without letters go.

    Without any label there is nothing to tell languages by, and all documents stay.
    """
    field = train_field(training_pieces(docs, "lang", "text"))
    if not field.labels:
        return docs
    return identify_languages(docs, field).filter(F.col("lang_pred") != UNDETERMINED).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target shares of their sources, in shuffled order."""
    return mix_sources(docs, source_rates(docs)).select(*docs.columns)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences with their global slots."""
    return materialise_order(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("token_shards", token_shards),
]

#: SQL cannot express the trained field, so the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
