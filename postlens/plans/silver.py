"""Silver: both boards in one shape, one row per url x category x location x city."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens import fixed_values as fv
from postlens.functions.experience import extract_experience, years_band, years_level, years_normalized
from postlens.functions.labels import education_level, names_other_places, work_arrangement, work_model
from postlens.functions.salary import max_salary, min_salary, salary_bench, salary_value
from postlens.functions.text import normal_location, strip, surrogate_key
from postlens.operators.lookups import lookup_join, pattern_join, regex_lookup, rows_per_value

BOARD_A, BOARD_B = "board_a", "board_b"


def with_category(df: DataFrame, title: str = "title", patterns=fv.CATEGORY_PATTERNS) -> DataFrame:
    """One row per category whose pattern the title matches, `Others` when none does.

    `patterns` is a list of (pattern, category) or a seed table (pattern, target_job_category) of any length.
    """
    lowered = F.lower(F.col(title))
    if isinstance(patterns, DataFrame):
        edged = patterns.withColumn("pattern", F.concat(F.lit("(?U)"), F.col("pattern")))
        matched = pattern_join(df, lowered, edged, "pattern", ["target_job_category"])
    else:
        unicode_edges = [("(?U)" + pattern, *rest) for pattern, *rest in patterns]
        matched = regex_lookup(df, lowered, unicode_edges, ["target_job_category"])
    category = F.coalesce("target_job_category", F.lit(fv.NO_CATEGORY))
    return matched.withColumn("job_category", category).drop("target_job_category")


def with_city(df: DataFrame, location: str = "working_location", patterns=fv.CITY_PATTERNS) -> DataFrame:
    """One row per city whose pattern the location matches, NULL when none does; `patterns` as a list or a seed table."""
    if isinstance(patterns, DataFrame):
        return pattern_join(df, F.col(location), patterns, "pattern", ["city_en"])
    return regex_lookup(df, F.col(location), [(p, city) for p, _, city, _ in patterns], ["city_en"])


def split_locations(df: DataFrame, location: str = "working_location") -> DataFrame:
    """One row per place of a `-` separated list, without `other places`; a NULL list drops the row."""
    places = df.withColumn("_place", F.explode(F.split(location, "-")))
    return places.filter(~names_other_places("_place")).withColumn(location, strip("_place")).drop("_place")


def _dated(df: DataFrame, *columns) -> DataFrame:
    return df.select(
        *columns,
        "posted_to_discord",
        F.to_date("created_at").alias("job_posted_date"),
        F.col("created_at").alias("job_posted_timestamp"),
    )


def _titled(bronze: DataFrame, patterns) -> DataFrame:
    """Rows with their categories, looked up once for each title."""
    return rows_per_value(bronze, "title", lambda titles: with_category(titles, patterns=patterns))


def int_board_a_jobs(bronze: DataFrame, platform: str = BOARD_A, patterns=fv.CATEGORY_PATTERNS) -> DataFrame:
    jobs = _titled(bronze.drop("job_category"), patterns)
    return _dated(
        jobs,
        F.lit(platform).alias("source_platform"),
        "url",
        "logo_url",
        "title",
        "company",
        normal_location("working_location").alias("working_location"),
        F.lit("Full-time").alias("work_arrangement"),
        "work_model",
        F.lit(None).cast("string").alias("salary"),
        "job_category",
        F.lit(None).cast("bigint").alias("salary_min_million"),
        F.lit(None).cast("bigint").alias("salary_max_million"),
        education_level("requirements_and_experiences").alias("education_requirement"),
        "descriptions",
        F.col("requirements_and_experiences").alias("requirements"),
        extract_experience("requirements_and_experiences").alias("year_of_experiences"),
        "tags",
    )


def int_board_b_jobs(bronze: DataFrame, platform: str = BOARD_B, patterns=fv.CATEGORY_PATTERNS) -> DataFrame:
    jobs = _titled(bronze.withColumnRenamed("job_category", "tags"), patterns)
    return _dated(
        jobs,
        F.lit(platform).alias("source_platform"),
        "url",
        "logo_url",
        "title",
        "company",
        normal_location("working_location").alias("working_location"),
        F.col("work_model").alias("work_arrangement"),
        F.lit("On-Site").alias("work_model"),
        "salary",
        "job_category",
        min_salary("salary").alias("salary_min_million"),
        max_salary("salary").alias("salary_max_million"),
        education_level("level_of_education").alias("education_requirement"),
        "descriptions",
        "requirements",
        extract_experience("experiences").alias("year_of_experiences"),
        "tags",
    )


def int_jobs_unified(
    board_a: DataFrame,
    board_b: DataFrame,
    logos: DataFrame,
    cities=fv.CITY_PATTERNS,
    load_time: Column | None = None,
    places: DataFrame | None = None,
) -> DataFrame:
    """All postings, enriched. The logo join runs before the fan-out over places: fewer rows to shuffle.

    `places` holds every `working_location` of both boards, if that is cheaper to read than the boards.
    """
    jobs = board_a.unionByName(board_b).filter(F.col("working_location").isNotNull())
    jobs = lookup_join(jobs, logos.select("logo_url", "logo_id"), "logo_url")
    split = lambda places: with_city(split_locations(places), patterns=cities)
    jobs = rows_per_value(jobs, "working_location", split, [board_a, board_b] if places is None else [places])
    jobs = jobs.withColumn("_average", salary_value("salary_min_million", "salary_max_million"))
    jobs = jobs.withColumn("_years", years_normalized("year_of_experiences"))
    return jobs.select(
        surrogate_key("source_platform", "url").alias("job_id"),
        "source_platform",
        "url",
        "logo_id",
        F.col("title").alias("job_title"),
        F.col("company").alias("company_name"),
        F.trim("city_en").alias("job_location"),
        "job_category",
        work_model("work_model").alias("work_model_normalized"),
        work_arrangement("work_arrangement").alias("work_arrangement_normalized"),
        "salary",
        "salary_min_million",
        "salary_max_million",
        F.col("_average").alias("salary_avg_million"),
        salary_bench("_average").alias("salary_band"),
        "education_requirement",
        "descriptions",
        "requirements",
        F.col("year_of_experiences").alias("year_of_experiences_raw"),
        F.col("_years").alias("year_of_experiences_normalized"),
        years_band("_years").alias("year_of_experiences"),
        years_level("_years").alias("experiences_level"),
        "tags",
        "posted_to_discord",
        "job_posted_date",
        "job_posted_timestamp",
        (F.current_timestamp() if load_time is None else load_time).alias("dbt_load_timestamp"),
    )
