"""Reports over the star schema.

Each report keeps every member of its dimension (left join). The fact is aggregated by the dimension key
first and the small result is joined: the fact is never shuffled for the join, and a member that holds a
third of all postings shrinks in the map-side partial aggregates. Counts of distinct urls under several
conditions share one `FILTER`ed distinct set, so rows are expanded once per distinct column, not per condition.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.operators.ranking import rank_few, rank_many
from postlens.session import materialise

REMOTE, HYBRID, ON_SITE = (f"work_model_normalized = '{m}'" for m in ("Remote", "Hybrid", "On-Site"))
FULL_TIME = "work_arrangement_normalized = 'Full-time'"
POSTED = "posted_to_discord"


def distinct(column: str, where: str | None = None) -> Column:
    condition = f" FILTER (WHERE {where})" if where else ""
    return F.expr(f"count(DISTINCT {column}){condition}")


def percent(part: Column, whole: Column) -> Column:
    return F.round(part * F.lit(100.0) / F.nullif(whole, F.lit(0)), 2)


def mean(column: str = "salary_avg_million") -> Column:
    return F.round(F.avg(column), 1)


def joined_values(column: str) -> Column:
    """Distinct values in one text, sorted; NULL when there are none."""
    return F.nullif(F.array_join(F.sort_array(F.collect_set(column)), ", "), F.lit(""))


def values_per_key(fact: DataFrame, key: str, column: str, name: str) -> DataFrame:
    """(key, name): the joined values of every key, from its distinct pairs.

    Kept apart from distinct counts: beside those, collecting a set would make Spark sort the expanded rows.
    """
    pairs = fact.select(key, column).dropna().distinct()
    return pairs.groupBy(key).agg(F.array_join(F.sort_array(F.collect_list(column)), ", ").alias(name))


def per_member(
    dim: DataFrame, fact: DataFrame, key: str, *measures: Column, counts: tuple[str, ...], values: dict[str, str] | None = None
) -> DataFrame:
    """Dimension members with their measures; counts are 0 for a member without postings.

    `values` names result columns that list the distinct values of a column.
    """
    rows = dim.join(fact.groupBy(key).agg(*measures), key, "left").fillna(0, subset=list(counts))
    for name, column in (values or {}).items():
        rows = rows.join(values_per_key(fact, key, column, name), key, "left")
        rows = rows.withColumn(name, F.nullif(F.col(name), F.lit("")))
    return rows


def rpt_company_hiring_summary(dim_company: DataFrame, fact: DataFrame) -> DataFrame:
    counts = ("total_job_postings", "num_locations", "discord_postings", "unique_job_titles")
    rows = per_member(
        dim_company,
        fact,
        "company_id",
        distinct("url").alias("total_job_postings"),
        distinct("job_location").alias("num_locations"),
        distinct("url", POSTED).alias("discord_postings"),
        F.min("job_posted_date").alias("first_posting_date"),
        F.max("job_posted_date").alias("last_posting_date"),
        mean().alias("avg_salary_offered"),
        distinct("job_title").alias("unique_job_titles"),
        counts=counts,
        values={"work_models_offered": "work_model_normalized"},
    )
    days = F.date_diff("last_posting_date", "first_posting_date") + 1
    ranked = rank_many(rows, [F.col("total_job_postings").desc(), F.col("company_id").asc()], "company_rank")
    return ranked.select(
        "company_id",
        "company_rank",
        "company_name",
        "source_platform",
        "logo_id",
        "total_job_postings",
        "num_locations",
        "discord_postings",
        percent(F.col("discord_postings"), F.col("total_job_postings")).alias("pct_discord_posted"),
        "first_posting_date",
        "last_posting_date",
        days.cast("bigint").alias("active_days_range"),
        "avg_salary_offered",
        "unique_job_titles",
        "work_models_offered",
    )


def _against_market(rows: DataFrame) -> DataFrame:
    """Group mean against the mean of the group means; `_mean` is the unrounded group mean."""
    market = rows.agg(F.avg("_mean").alias("_market"))
    rows = rows.withColumn("_market", market.scalar())
    return rows.select(
        "*",
        F.round("_mean", 1).alias("avg_salary"),
        F.round("_market", 1).alias("market_avg_salary"),
        F.round(F.col("_mean") - F.col("_market"), 1).alias("salary_vs_market"),
    )


def rpt_education_distribution(dim_education: DataFrame, fact: DataFrame) -> DataFrame:
    rows = per_member(
        dim_education.select("education_id", "education_requirement", "education_sort_order"),
        fact,
        "education_id",
        F.count("job_id").alias("job_count"),
        distinct("company_id").alias("num_companies"),
        distinct("location_id").alias("num_locations"),
        F.avg("salary_avg_million").alias("_mean"),
        counts=("job_count", "num_companies", "num_locations"),
        values={"source_platforms": "source_platform"},
    )
    total = fact.agg(F.count("*")).scalar()
    everyone = Window.partitionBy()  # five levels at most
    rows = rows.withColumn("_market", F.avg("_mean").over(everyone))
    rows = rank_few(rows, [F.col("job_count").desc(), F.col("education_id").asc()], "demand_rank")
    return rows.select(
        "education_id",
        "education_requirement",
        "education_sort_order",
        "job_count",
        "num_companies",
        "num_locations",
        F.round("_mean", 1).alias("avg_salary"),
        percent(F.col("job_count"), total).alias("pct_of_total_jobs"),
        "source_platforms",
        "demand_rank",
        F.round("_market", 1).alias("market_avg_salary"),
        F.round(F.col("_mean") - F.col("_market"), 1).alias("salary_vs_market"),
    )


def rpt_job_category_analysis(dim_job_category: DataFrame, fact: DataFrame) -> DataFrame:
    counts = ("num_positions", "num_companies", "num_locations", "remote_positions", "hybrid_positions")
    rows = per_member(
        dim_job_category.select("job_category_id", "job_category"),
        fact,
        "job_category_id",
        F.count("job_id").alias("num_positions"),
        distinct("company_id").alias("num_companies"),
        distinct("location_id").alias("num_locations"),
        mean().alias("avg_salary"),
        F.min("salary_min_million").alias("min_salary"),
        F.max("salary_max_million").alias("max_salary"),
        distinct("url", REMOTE).alias("remote_positions"),
        distinct("url", HYBRID).alias("hybrid_positions"),
        counts=counts,
    )
    total = fact.agg(F.count("*")).scalar()
    rows = rows.withColumn("pct_of_all_jobs", percent(F.col("num_positions"), total))
    return rank_few(rows, [F.col("num_positions").desc(), F.col("job_category_id").asc()], "demand_rank")


def rpt_job_market_daily(fact: DataFrame) -> DataFrame:
    rows = fact.groupBy("job_posted_date", "source_platform").agg(
        F.count("*").alias("daily_job_postings"),
        distinct("company_id").alias("unique_companies_posting"),
        distinct("location_id").alias("unique_locations"),
        distinct("url", POSTED).alias("discord_posted_count"),
        mean().alias("avg_salary_offered"),
        F.max("salary_max_million").alias("max_salary_offered"),
        F.min("salary_min_million").alias("min_salary_offered"),
        distinct("url", REMOTE).alias("remote_jobs"),
        distinct("url", HYBRID).alias("hybrid_jobs"),
        distinct("url", ON_SITE).alias("onsite_jobs"),
        distinct("url", FULL_TIME).alias("fulltime_jobs"),
    )
    share = percent(F.col("discord_posted_count"), F.col("daily_job_postings"))
    return rows.withColumn("pct_posted_to_discord", share)


def rpt_location_salary_analysis(dim_location: DataFrame, fact: DataFrame) -> DataFrame:
    counts = (
        "total_jobs", "num_companies", "num_platforms", "remote_jobs", "hybrid_jobs", "onsite_jobs", "fulltime_jobs",
    )
    rows = per_member(
        dim_location.select("location_id", "job_location", "country"),
        fact,
        "location_id",
        distinct("url").alias("total_jobs"),
        distinct("company_id").alias("num_companies"),
        distinct("source_platform").alias("num_platforms"),
        F.avg("salary_avg_million").alias("_mean"),
        F.max("salary_max_million").alias("highest_salary"),
        F.min("salary_min_million").alias("lowest_salary"),
        distinct("url", REMOTE).alias("remote_jobs"),
        distinct("url", HYBRID).alias("hybrid_jobs"),
        distinct("url", ON_SITE).alias("onsite_jobs"),
        distinct("url", FULL_TIME).alias("fulltime_jobs"),
        counts=counts,
        values={"education_requirements": "education_requirement"},
    )
    total = fact.agg(F.count_distinct("url")).scalar()
    rows = rank_few(rows, [F.col("_mean").desc_nulls_last(), F.col("location_id").asc()], "salary_rank")
    return rows.select(
        "location_id",
        "salary_rank",
        "job_location",
        "country",
        "total_jobs",
        "num_companies",
        "num_platforms",
        percent(F.col("total_jobs"), total).alias("pct_of_total_jobs"),
        F.round("_mean", 1).alias("avg_salary_by_location"),
        "highest_salary",
        "lowest_salary",
        "remote_jobs",
        "hybrid_jobs",
        "onsite_jobs",
        "fulltime_jobs",
        percent(F.col("remote_jobs"), F.col("total_jobs")).alias("pct_remote"),
        percent(F.col("hybrid_jobs"), F.col("total_jobs")).alias("pct_hybrid"),
        "education_requirements",
    )


def rpt_platform_comparison(fact: DataFrame) -> DataFrame:
    rows = fact.groupBy("source_platform").agg(
        F.count("*").alias("total_job_postings"),
        distinct("company_id").alias("unique_companies"),
        distinct("location_id").alias("unique_locations"),
        distinct("job_title").alias("unique_job_titles"),
        distinct("url", POSTED).alias("_posted"),
        distinct("url", REMOTE).alias("remote_jobs_count"),
        distinct("url", HYBRID).alias("hybrid_jobs_count"),
        distinct("url", ON_SITE).alias("onsite_jobs_count"),
        distinct("url", FULL_TIME).alias("fulltime_jobs_count"),
        mean().alias("avg_salary"),
        distinct("url", "salary_avg_million IS NOT NULL").alias("salaried_positions_count"),
        F.min("job_posted_date").alias("earliest_job_date"),
        F.max("job_posted_date").alias("latest_job_date"),
    )
    share = percent(F.col("_posted"), F.col("total_job_postings"))
    return rows.withColumn("pct_discord_posted", share).drop("_posted")


def exact_quartiles(fact: DataFrame, key: str, value: str, fractions: dict[str, float]) -> DataFrame:
    """Smallest value whose cumulative share reaches each fraction, per key.

    Equal values are counted before the shuffle, and the counts are laid out in ranges of (key, value), so a key with most
    of the values lies in many of them. The sums of the ranges tell in which one each fraction is reached; only those
    ranges are looked into, each for itself.
    """
    counted = fact.filter(F.col(value).isNotNull()).groupBy(F.col(key).alias("_key"), F.col(value).alias("_value")).agg(F.count("*").alias("_n"))
    ranged = materialise(counted.repartitionByRange("_key", "_value").withColumn("_range", F.spark_partition_id()), "quartile-ranges")
    of_key = Window.partitionBy("_key")
    earlier = of_key.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_key", "_range").agg(F.sum("_n").alias("_n"))
    sums = sums.select(
        F.col("_key").alias("_k"), F.col("_range").alias("_r"), "_n", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(of_key).alias("_all"),
    )
    reached = [F.col("_all") * F.lit(f) for f in fractions.values()]
    deciding = sums.filter(reduce(or_, [(F.col("_before") < at) & (F.col("_before") + F.col("_n") >= at) for at in reached])).drop("_n")
    inside = Window.partitionBy("_range", "_key").orderBy("_value")
    looked = ranged.join(deciding, (F.col("_range") == F.col("_r")) & F.col("_key").eqNullSafe(F.col("_k")))
    placed = looked.select("_key", "_value", "_all", (F.col("_before") + F.sum("_n").over(inside)).alias("_upto"), "_before")
    first = lambda at: F.min(F.when((F.col("_upto") >= at) & (F.col("_before") < at), F.col("_value")))
    return placed.groupBy(F.col("_key").alias(key)).agg(*[first(at).alias(name) for at, name in zip(reached, fractions)])


def rpt_salary_benchmark(dim_salary_band: DataFrame, fact: DataFrame, exact: bool = False) -> DataFrame:
    """Salary statistics per band; quartiles from a mergeable sketch, or exact ones on request."""
    quartiles = {"salary_q1": 0.25, "salary_median": 0.5, "salary_q3": 0.75}
    counts = ("num_positions", "salaried_positions", "remote_positions", "hybrid_positions", "onsite_positions")
    sketch = F.percentile_approx("salary_avg_million", list(quartiles.values()), 10_000).alias("_quartiles")
    rows = per_member(
        dim_salary_band.select(
            "salary_band_id", "salary_band", "salary_band_sort_order", "lower_bound_vnd", "upper_bound_vnd"
        ),
        fact,
        "salary_band_id",
        F.count("job_id").alias("num_positions"),
        distinct("url", "salary_avg_million IS NOT NULL").alias("salaried_positions"),
        mean().alias("avg_salary"),
        F.min("salary_min_million").alias("min_salary"),
        F.max("salary_max_million").alias("max_salary"),
        distinct("url", REMOTE).alias("remote_positions"),
        distinct("url", HYBRID).alias("hybrid_positions"),
        distinct("url", ON_SITE).alias("onsite_positions"),
        *([] if exact else [sketch]),
        counts=counts,
    )
    if exact:
        return rows.join(exact_quartiles(fact, "salary_band_id", "salary_avg_million", quartiles), "salary_band_id", "left")
    picked = [F.col("_quartiles")[i].alias(name) for i, name in enumerate(quartiles)]
    return rows.select("*", *picked).drop("_quartiles")


def rpt_work_model_analysis(dim_work_model: DataFrame, fact: DataFrame) -> DataFrame:
    """Work models are free text where no known word matches, so their number is not bounded."""
    rows = per_member(
        dim_work_model.select("work_model_id", "work_model_normalized", "work_model_group", "work_model_sort_order"),
        fact,
        "work_model_id",
        distinct("url").alias("job_count"),
        distinct("company_id").alias("num_companies"),
        distinct("location_id").alias("num_locations"),
        F.avg("salary_avg_million").alias("_mean"),
        distinct("source_platform").alias("num_platforms"),
        counts=("job_count", "num_companies", "num_locations", "num_platforms"),
    )
    ranked = rank_many(rows, [F.col("job_count").desc(), F.col("work_model_id").asc()], "demand_rank")
    total = fact.agg(F.count_distinct("url")).scalar()
    above = F.col("_mean") > F.col("_market")
    below = F.col("_mean") < F.col("_market")
    position = F.when(above, "Above Average").when(below, "Below Average").otherwise("At Market")
    return (
        _against_market(ranked)
        .withColumn("salary_positioning", position)
        .withColumn("pct_of_total_jobs", percent(F.col("job_count"), total))
        .drop("_mean", "_market")
    )
