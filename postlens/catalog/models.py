"""Bronze, silver, gold and report models over the postings fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlens.catalog import fixture as fx
from postlens.catalog.fixture import key_sql, with_ctes
from postlens.catalog.registry import query
from postlens.plans import gold, reports

NO_LOAD = "dbt_load_timestamp"


def _dim_sql(column: str, key: str, extra: str = "") -> str:
    return with_ctes(
        f"SELECT {key_sql(column)} AS {key}, {column} {extra} "
        f"FROM (SELECT DISTINCT {column} FROM wanted WHERE {column} IS NOT NULL)"
    )


def _case_sql(column: str, values: dict, default: str = "NULL") -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + f" ELSE {default} END"


# ---- bronze, silver, gold ------------------------------------------------------------------


@query("stg_board_a_jobs", with_ctes("SELECT * FROM bronze_a", "bronze_a"))
def stg_a(spark, sf_dir):
    return fx.bronze_a(spark, sf_dir)


@query("stg_board_b_jobs", with_ctes("SELECT * FROM bronze_b", "bronze_b"))
def stg_b(spark, sf_dir):
    return fx.bronze_b(spark, sf_dir)


@query("int_board_a_jobs", with_ctes("SELECT * FROM silver_a", "silver_a"))
def int_a(spark, sf_dir):
    return fx.silver_a(spark, sf_dir)


@query("int_board_b_jobs", with_ctes("SELECT * FROM silver_b", "silver_b"))
def int_b(spark, sf_dir):
    return fx.silver_b(spark, sf_dir)


@query("int_jobs_unified", with_ctes(f"SELECT * EXCLUDE ({NO_LOAD}) FROM unified", "unified"))
def int_unified(spark, sf_dir):
    return fx.unified(spark, sf_dir).drop(NO_LOAD)


DIM_COMPANY = f"""SELECT {key_sql('source_platform', 'company_name')} AS company_id, company_name, source_platform, logo_id
  FROM (SELECT *, row_number() OVER (PARTITION BY source_platform, company_name
          ORDER BY job_posted_timestamp DESC NULLS LAST, url ASC, logo_id ASC NULLS LAST) AS rn
        FROM wanted WHERE company_name IS NOT NULL) WHERE rn = 1"""


@query("dim_company", with_ctes(DIM_COMPANY))
def dim_company(spark, sf_dir):
    return gold.dim_company(fx.unified(spark, sf_dir)).drop(NO_LOAD)


@query("dim_company_logo", with_ctes("SELECT DISTINCT logo_id, logo_path FROM logos", "logos"))
def dim_company_logo(spark, sf_dir):
    return gold.dim_company_logo(fx.logos(spark, sf_dir))


EDUCATION_ORDER = {"College": 1, "Bachelor": 2, "Master": 3, "PhD": 4, "Unknown": 99}


@query(
    "dim_education",
    _dim_sql(
        "education_requirement",
        "education_id",
        f", {_case_sql('education_requirement', EDUCATION_ORDER, '98')} AS education_sort_order,"
        " education_requirement <> 'Unknown' AS is_specified",
    ),
)
def dim_education(spark, sf_dir):
    return gold.dim_education(fx.unified(spark, sf_dir)).drop(NO_LOAD)


@query("dim_job_category", _dim_sql("job_category", "job_category_id"))
def dim_job_category(spark, sf_dir):
    return gold.dim_job_category(fx.unified(spark, sf_dir)).drop(NO_LOAD)


@query(
    "dim_location",
    _dim_sql("job_location", "location_id", ", 'Vietnam' AS country, trim(job_location) = '' AS is_unknown_location"),
)
def dim_location(spark, sf_dir):
    return gold.dim_location(fx.unified(spark, sf_dir)).drop(NO_LOAD)


BANDS = ["Below 10M VND", *[f"{i}0-{i + 1}0M VND" for i in range(1, 10)], "Above 100M VND"]
BAND_EXTRA = (
    f", {_case_sql('salary_band', {**{b: i + 1 for i, b in enumerate(BANDS)}, 'Not Specified': 99}, '98')}"
    " AS salary_band_sort_order,"
    f" ({_case_sql('salary_band', {b: i * 10_000_000 for i, b in enumerate(BANDS)})})::BIGINT AS lower_bound_vnd,"
    f" ({_case_sql('salary_band', {b: (i + 1) * 10_000_000 for i, b in enumerate(BANDS[:-1])})})::BIGINT"
    " AS upper_bound_vnd, salary_band <> 'Not Specified' AS is_salary_specified"
)


@query("dim_salary_band", _dim_sql("salary_band", "salary_band_id", BAND_EXTRA))
def dim_salary_band(spark, sf_dir):
    return gold.dim_salary_band(fx.unified(spark, sf_dir)).drop(NO_LOAD)


GROUPS = {"Remote": "'Offsite'", "Hybrid": "'Mixed'", "On-Site": "'Office'"}
MODEL_EXTRA = (
    f", {_case_sql('work_model_normalized', GROUPS, chr(39) + 'Other' + chr(39))} AS work_model_group,"
    f" {_case_sql('work_model_normalized', {'On-Site': 1, 'Hybrid': 2, 'Remote': 3}, '99')} AS work_model_sort_order"
)


@query("dim_work_model", _dim_sql("work_model_normalized", "work_model_id", MODEL_EXTRA))
def dim_work_model(spark, sf_dir):
    return gold.dim_work_model(fx.unified(spark, sf_dir)).drop(NO_LOAD)


@query(
    "load_time",
    "SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS dbt_load_timestamp FROM (" + _dim_sql("work_model_normalized", "work_model_id", MODEL_EXTRA) + ")",
)
def load_time(spark, sf_dir):
    """A model with its load time, which the other registered models leave out."""
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return gold.dim_work_model(fx.unified(spark, sf_dir).drop(NO_LOAD), stamp)


@query("fct_jobs", with_ctes(f"SELECT * EXCLUDE ({NO_LOAD}) FROM fact"))
def fct_jobs(spark, sf_dir):
    return fx.fact(spark, sf_dir).drop(NO_LOAD)


# ---- reports -------------------------------------------------------------------------------


def _names(column: str) -> str:
    return f"string_agg(DISTINCT {column}, ', ' ORDER BY {column})"


REMOTE = "count(DISTINCT CASE WHEN f.work_model_normalized = 'Remote' THEN f.url END)"
HYBRID = "count(DISTINCT CASE WHEN f.work_model_normalized = 'Hybrid' THEN f.url END)"
ONSITE = "count(DISTINCT CASE WHEN f.work_model_normalized = 'On-Site' THEN f.url END)"
FULLTIME = "count(DISTINCT CASE WHEN f.work_arrangement_normalized = 'Full-time' THEN f.url END)"
POSTED = "count(DISTINCT CASE WHEN f.posted_to_discord THEN f.url END)"
SALARIED = "count(DISTINCT CASE WHEN f.salary_avg_million IS NOT NULL THEN f.url END)"

COMPANY = f"""
SELECT c.company_id, row_number() OVER (ORDER BY count(DISTINCT f.url) DESC, c.company_id) AS company_rank,
  c.company_name, c.source_platform, c.logo_id, count(DISTINCT f.url) AS total_job_postings,
  count(DISTINCT f.job_location) AS num_locations, {POSTED} AS discord_postings,
  round(100.0 * {POSTED} / nullif(count(DISTINCT f.url), 0), 2) AS pct_discord_posted,
  min(f.job_posted_date) AS first_posting_date, max(f.job_posted_date) AS last_posting_date,
  date_diff('day', min(f.job_posted_date), max(f.job_posted_date)) + 1 AS active_days_range,
  round(avg(f.salary_avg_million), 1) AS avg_salary_offered, count(DISTINCT f.job_title) AS unique_job_titles,
  {_names('f.work_model_normalized')} AS work_models_offered
FROM ({DIM_COMPANY}) c LEFT JOIN fact f ON c.company_id = f.company_id
GROUP BY c.company_id, c.company_name, c.source_platform, c.logo_id"""


@query("rpt_company_hiring_summary", with_ctes(COMPANY))
def rpt_company(spark, sf_dir):
    jobs = fx.wanted_table(spark, sf_dir, "job_title", "logo_id", "job_posted_timestamp", ids=False)
    return reports.rpt_company_hiring_summary(gold.dim_company(jobs), gold.fct_jobs(jobs))


EDUCATION = f"""
SELECT *, round(avg(m) OVER (), 1) AS market_avg_salary, round(m - avg(m) OVER (), 1) AS salary_vs_market FROM (
SELECT f.education_id, f.education_requirement,
  {_case_sql('f.education_requirement', EDUCATION_ORDER, '98')} AS education_sort_order, count(f.job_id) AS job_count,
  count(DISTINCT f.company_id) AS num_companies, count(DISTINCT f.location_id) AS num_locations,
  round(avg(f.salary_avg_million), 1) AS avg_salary, avg(f.salary_avg_million) AS m,
  round(100.0 * count(f.job_id) / nullif((SELECT count(*) FROM fact), 0), 2) AS pct_of_total_jobs,
  {_names('f.source_platform')} AS source_platforms,
  row_number() OVER (ORDER BY count(f.job_id) DESC, f.education_id) AS demand_rank
FROM fact f GROUP BY f.education_id, f.education_requirement)"""


@query("rpt_education_distribution", with_ctes(f"SELECT * EXCLUDE (m) FROM ({EDUCATION})"))
def rpt_education(spark, sf_dir):
    jobs = fx.wanted_table(spark, sf_dir)
    return reports.rpt_education_distribution(gold.dim_education(jobs), gold.fct_jobs(jobs))


CATEGORY = f"""
SELECT f.job_category_id, row_number() OVER (ORDER BY count(f.job_id) DESC, f.job_category_id) AS demand_rank,
  f.job_category, count(f.job_id) AS num_positions, count(DISTINCT f.company_id) AS num_companies,
  count(DISTINCT f.location_id) AS num_locations,
  round(100.0 * count(f.job_id) / nullif((SELECT count(*) FROM fact), 0), 2) AS pct_of_all_jobs,
  round(avg(f.salary_avg_million), 1) AS avg_salary, min(f.salary_min_million) AS min_salary,
  max(f.salary_max_million) AS max_salary, {REMOTE} AS remote_positions, {HYBRID} AS hybrid_positions
FROM fact f GROUP BY f.job_category_id, f.job_category"""


@query("rpt_job_category_analysis", with_ctes(CATEGORY))
def rpt_category(spark, sf_dir):
    jobs = fx.wanted_table(spark, sf_dir)
    return reports.rpt_job_category_analysis(gold.dim_job_category(jobs), gold.fct_jobs(jobs))


DAILY = f"""
SELECT job_posted_date, source_platform, count(*) AS daily_job_postings,
  count(DISTINCT company_id) AS unique_companies_posting, count(DISTINCT location_id) AS unique_locations,
  {POSTED} AS discord_posted_count, round(100.0 * {POSTED} / nullif(count(*), 0), 2) AS pct_posted_to_discord,
  round(avg(salary_avg_million), 1) AS avg_salary_offered, max(salary_max_million) AS max_salary_offered,
  min(salary_min_million) AS min_salary_offered, {REMOTE} AS remote_jobs, {HYBRID} AS hybrid_jobs,
  {ONSITE} AS onsite_jobs, {FULLTIME} AS fulltime_jobs
FROM fact f GROUP BY job_posted_date, source_platform"""


@query("rpt_job_market_daily", with_ctes(DAILY))
def rpt_daily(spark, sf_dir):
    return reports.rpt_job_market_daily(fx.fact(spark, sf_dir))


LOCATION = f"""
SELECT f.location_id,
  row_number() OVER (ORDER BY avg(f.salary_avg_million) DESC NULLS LAST, f.location_id) AS salary_rank,
  f.job_location, 'Vietnam' AS country, count(DISTINCT f.url) AS total_jobs,
  count(DISTINCT f.company_id) AS num_companies, count(DISTINCT f.source_platform) AS num_platforms,
  round(100.0 * count(DISTINCT f.url) / nullif((SELECT count(DISTINCT url) FROM fact), 0), 2) AS pct_of_total_jobs,
  round(avg(f.salary_avg_million), 1) AS avg_salary_by_location, max(f.salary_max_million) AS highest_salary,
  min(f.salary_min_million) AS lowest_salary, {REMOTE} AS remote_jobs, {HYBRID} AS hybrid_jobs,
  {ONSITE} AS onsite_jobs, {FULLTIME} AS fulltime_jobs,
  round(100.0 * {REMOTE} / nullif(count(DISTINCT f.url), 0), 2) AS pct_remote,
  round(100.0 * {HYBRID} / nullif(count(DISTINCT f.url), 0), 2) AS pct_hybrid,
  {_names('f.education_requirement')} AS education_requirements
FROM fact f WHERE f.location_id IS NOT NULL GROUP BY f.location_id, f.job_location"""


@query("rpt_location_salary_analysis", with_ctes(LOCATION))
def rpt_location(spark, sf_dir):
    jobs = fx.wanted_table(spark, sf_dir, ids=False)
    return reports.rpt_location_salary_analysis(gold.dim_location(jobs), gold.fct_jobs(jobs))


PLATFORM = f"""
SELECT source_platform, count(*) AS total_job_postings, count(DISTINCT company_id) AS unique_companies,
  count(DISTINCT location_id) AS unique_locations, count(DISTINCT job_title) AS unique_job_titles,
  round(100.0 * {POSTED} / nullif(count(*), 0), 2) AS pct_discord_posted, {REMOTE} AS remote_jobs_count,
  {HYBRID} AS hybrid_jobs_count, {ONSITE} AS onsite_jobs_count, {FULLTIME} AS fulltime_jobs_count,
  round(avg(salary_avg_million), 1) AS avg_salary, {SALARIED} AS salaried_positions_count,
  min(job_posted_date) AS earliest_job_date, max(job_posted_date) AS latest_job_date
FROM fact f GROUP BY source_platform"""


@query("rpt_platform_comparison", with_ctes(PLATFORM))
def rpt_platform(spark, sf_dir):
    return reports.rpt_platform_comparison(fx.fact(spark, sf_dir))


SALARY = f"""
SELECT s.*, count(f.job_id) AS num_positions, {SALARIED} AS salaried_positions,
  round(avg(f.salary_avg_million), 1) AS avg_salary,
  quantile_disc(f.salary_avg_million, 0.25) AS salary_q1, quantile_disc(f.salary_avg_million, 0.5) AS salary_median,
  quantile_disc(f.salary_avg_million, 0.75) AS salary_q3, min(f.salary_min_million) AS min_salary,
  max(f.salary_max_million) AS max_salary, {REMOTE} AS remote_positions, {HYBRID} AS hybrid_positions,
  {ONSITE} AS onsite_positions
FROM (SELECT salary_band_id, salary_band {BAND_EXTRA.rsplit(', salary_band <>', 1)[0]}
      FROM (SELECT DISTINCT salary_band_id, salary_band FROM fact)) s
LEFT JOIN fact f ON s.salary_band_id = f.salary_band_id GROUP BY ALL"""


@query("rpt_salary_benchmark", with_ctes(SALARY))
def rpt_salary(spark, sf_dir):
    jobs = fx.wanted_table(spark, sf_dir)
    return reports.rpt_salary_benchmark(gold.dim_salary_band(jobs), gold.fct_jobs(jobs), exact=True)


@query("rpt_salary_benchmark_sketch")
def rpt_salary_sketch(spark, sf_dir):
    jobs = fx.wanted_table(spark, sf_dir)
    return reports.rpt_salary_benchmark(gold.dim_salary_band(jobs), gold.fct_jobs(jobs))


WORK_MODEL = f"""
SELECT *, round(avg(m) OVER (), 1) AS market_avg_salary, round(m - avg(m) OVER (), 1) AS salary_vs_market,
  CASE WHEN m > avg(m) OVER () THEN 'Above Average' WHEN m < avg(m) OVER () THEN 'Below Average'
       ELSE 'At Market' END AS salary_positioning FROM (
SELECT f.work_model_id, f.work_model_normalized,
  {_case_sql('f.work_model_normalized', GROUPS, chr(39) + 'Other' + chr(39))} AS work_model_group,
  {_case_sql('f.work_model_normalized', {'On-Site': 1, 'Hybrid': 2, 'Remote': 3}, '99')} AS work_model_sort_order,
  count(DISTINCT f.url) AS job_count, count(DISTINCT f.company_id) AS num_companies,
  count(DISTINCT f.location_id) AS num_locations, round(avg(f.salary_avg_million), 1) AS avg_salary,
  round(count(DISTINCT f.url) * 100.0 / nullif((SELECT count(DISTINCT url) FROM fact), 0), 2) AS pct_of_total_jobs,
  count(DISTINCT f.source_platform) AS num_platforms, avg(f.salary_avg_million) AS m,
  row_number() OVER (ORDER BY count(DISTINCT f.url) DESC, f.work_model_id) AS demand_rank
FROM fact f WHERE f.work_model_id IS NOT NULL GROUP BY f.work_model_id, f.work_model_normalized)"""


@query("rpt_work_model_analysis", with_ctes(f"SELECT * EXCLUDE (m) FROM ({WORK_MODEL})"))
def rpt_work_model(spark, sf_dir):
    jobs = fx.wanted_table(spark, sf_dir, ids=False)
    return reports.rpt_work_model_analysis(gold.dim_work_model(jobs), gold.fct_jobs(jobs))
