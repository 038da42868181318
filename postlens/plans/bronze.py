"""Bronze: cleaned staging rows per board, merged by url above the high-water mark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.text import initcap_trim, lower_trim, strip, strip_commas, upper_trim
from postlens.operators.lookups import per_value
from postlens.operators.merge import merge_by_key, newer_than, one_per_key


def bronze_place(c: Column | str) -> Column:
    """A crawled place as both models have it."""
    return initcap_trim(c)


def _capitalised(staging: DataFrame, *names: str) -> DataFrame:
    """The place and other short columns in capitals, each distinct text once."""
    made = {c: {c: initcap_trim} for c in names}
    return per_value(staging, {"working_location": {"working_location": bronze_place}, **made})


def stg_board_a_jobs(staging: DataFrame) -> DataFrame:
    return _capitalised(staging, "title", "work_model", "tags").select(
        F.col("id").alias("source_job_id"),
        "title",
        upper_trim("company").alias("company"),
        strip("logo_url").alias("logo_url"),
        strip("url").alias("url"),
        "job_category",
        "working_location",
        "work_model",
        "tags",
        lower_trim("descriptions").alias("descriptions"),
        lower_trim("requirements_and_experiences").alias("requirements_and_experiences"),
        "posted_to_discord",
        "created_at",
    )


def stg_board_b_jobs(staging: DataFrame) -> DataFrame:
    return _capitalised(staging, "title", "salary", "level_of_education", "work_model").select(
        F.col("id").alias("source_job_id"),
        "title",
        upper_trim("company").alias("company"),
        strip("logo_url").alias("logo_url"),
        strip("url").alias("url"),
        "job_category",
        "working_location",
        strip_commas("salary").alias("salary"),
        lower_trim("descriptions").alias("descriptions"),
        lower_trim("requirements").alias("requirements"),
        lower_trim("experiences").alias("experiences"),
        "level_of_education",
        "work_model",
        "posted_to_discord",
        "created_at",
    )


def merge_bronze(model, staging: DataFrame, existing: DataFrame | None, inclusive: bool = False) -> DataFrame:
    """Next state of a bronze table: rows newer than its mark replace or join what it holds.

    Urls that become equal when they are trimmed are one posting, its newest record.
    """
    changes = model(newer_than(staging, existing, "created_at", inclusive))
    newest = [F.col("created_at").desc(), F.col("source_job_id").desc()]
    return one_per_key(changes, ["url"], newest) if existing is None else merge_by_key(existing, changes, ["url"], newest)
