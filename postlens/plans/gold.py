"""Gold: seven dimensions and the posting fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens import fixed_values as fv
from postlens.functions.labels import (
    band_lower,
    band_order,
    band_upper,
    education_order,
    work_model_group,
    work_model_order,
)
from postlens.functions.text import surrogate_key
from postlens.operators.keys import top_per_key


def categorised(jobs: DataFrame) -> DataFrame:
    """Postings with a real category; NULL categories fail the comparison too."""
    return jobs.filter(F.col("job_category") != fv.NO_CATEGORY)


def _load_time(load_time: Column | None) -> Column:
    return (F.current_timestamp() if load_time is None else load_time).alias("dbt_load_timestamp")


def _members(jobs: DataFrame, column: str, key: str) -> DataFrame:
    """Distinct members of one column with their key; the key is hashed after the rows are made distinct."""
    members = categorised(jobs).filter(F.col(column).isNotNull()).select(column).distinct()
    return members.select(surrogate_key(column).alias(key), column)


def dim_company(jobs: DataFrame, load_time: Column | None = None) -> DataFrame:
    """Latest posting of each company on each platform; ties go to the smallest url."""
    named = categorised(jobs).filter(F.col("company_name").isNotNull())
    slim = named.select("source_platform", "company_name", "logo_id", "job_posted_timestamp", "url")
    order = [F.col("job_posted_timestamp").desc_nulls_last(), F.col("url").asc(), F.col("logo_id").asc_nulls_last()]
    latest = top_per_key(slim, ["source_platform", "company_name"], order)
    return latest.select(
        surrogate_key("source_platform", "company_name").alias("company_id"),
        "company_name",
        "source_platform",
        "logo_id",
        _load_time(load_time),
    )


def dim_company_logo(logos: DataFrame) -> DataFrame:
    return logos.select("logo_id", "logo_path").distinct()


def dim_education(jobs: DataFrame, load_time: Column | None = None) -> DataFrame:
    return _members(jobs, "education_requirement", "education_id").select(
        "*",
        education_order("education_requirement").alias("education_sort_order"),
        (F.col("education_requirement") != fv.UNKNOWN).alias("is_specified"),
        _load_time(load_time),
    )


def dim_job_category(jobs: DataFrame, load_time: Column | None = None) -> DataFrame:
    return _members(jobs, "job_category", "job_category_id").select("*", _load_time(load_time))


def dim_location(jobs: DataFrame, load_time: Column | None = None) -> DataFrame:
    return _members(jobs, "job_location", "location_id").select(
        "*",
        F.lit(fv.COUNTRY).alias("country"),
        (F.trim("job_location") == "").alias("is_unknown_location"),
        _load_time(load_time),
    )


def dim_salary_band(jobs: DataFrame, load_time: Column | None = None) -> DataFrame:
    return _members(jobs, "salary_band", "salary_band_id").select(
        "*",
        band_order("salary_band").alias("salary_band_sort_order"),
        band_lower("salary_band").alias("lower_bound_vnd"),
        band_upper("salary_band").alias("upper_bound_vnd"),
        (F.col("salary_band") != fv.UNSPECIFIED_BAND).alias("is_salary_specified"),
        _load_time(load_time),
    )


def dim_work_model(jobs: DataFrame, load_time: Column | None = None) -> DataFrame:
    return _members(jobs, "work_model_normalized", "work_model_id").select(
        "*",
        work_model_group("work_model_normalized").alias("work_model_group"),
        work_model_order("work_model_normalized").alias("work_model_sort_order"),
        _load_time(load_time),
    )


FACT_COLUMNS = (
    "source_platform", "url", "logo_id", "job_title", "company_name", "job_location", "job_category",
    "work_model_normalized", "work_arrangement_normalized", "year_of_experiences_raw",
    "year_of_experiences_normalized", "year_of_experiences", "experiences_level", "salary",
    "salary_min_million", "salary_max_million", "salary_avg_million", "salary_band",
    "education_requirement", "tags", "posted_to_discord", "job_posted_date", "job_posted_timestamp",
    "dbt_load_timestamp",
)


def fct_jobs(jobs: DataFrame) -> DataFrame:
    """One row per silver row with a category; its id and attributes are left out if `jobs` was stripped of them."""
    attributes = [c for c in FACT_COLUMNS if c in jobs.columns]
    return categorised(jobs).select(
        *[c for c in ("job_id",) if c in jobs.columns],
        surrogate_key("job_category").alias("job_category_id"),
        surrogate_key("source_platform", "company_name").alias("company_id"),
        surrogate_key("work_model_normalized").alias("work_model_id"),
        surrogate_key("job_location").alias("location_id"),
        surrogate_key("education_requirement").alias("education_id"),
        surrogate_key("salary_band").alias("salary_band_id"),
        *attributes,
    )
