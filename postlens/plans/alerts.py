"""Alerts: postings not announced yet, and the record each alert is made of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.text import filled, strip


def pending_jobs(staging: DataFrame, salary_text: str | None = None) -> DataFrame:
    """Unannounced postings; `salary_text` stands in for a board that shows no salary."""
    salary: Column = F.col("salary") if salary_text is None else F.lit(salary_text)
    return staging.filter(~F.col("posted_to_discord")).select(
        "title",
        "url",
        F.col("logo_url").alias("logo"),
        F.col("working_location").alias("location"),
        salary.alias("salary"),
    )


def alert_records(jobs: DataFrame) -> DataFrame:
    """Title, link, picture, place and salary of an alert; an empty picture or place is left out (NULL)."""
    kept = lambda c: F.when(F.col(c) != "", strip(c))
    return jobs.select(
        strip(F.coalesce("title", F.lit(""))).alias("title"),
        strip(F.coalesce("url", F.lit(""))).alias("url"),
        kept("logo").alias("thumbnail"),
        kept("location").alias("location"),
        filled("salary", "Negotiable").alias("salary"),
    )
