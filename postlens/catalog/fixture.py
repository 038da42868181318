"""Job postings derived from the driver tables: one raw posting per lineitem row.

`POSTINGS` is SQL that Spark and DuckDB read alike; the CTEs below it are the checking side only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.catalog.registry import table
from postlens.functions.text import logo_key, normal_location, surrogate_key
from postlens.plans import gold, silver
from postlens.plans.bronze import bronze_place, stg_board_a_jobs, stg_board_b_jobs
from postlens.session import materialise, settled

POSTINGS = """
SELECT l_orderkey * 10 + l_linenumber AS id,
       concat('https://jobs.example/', cast(l_orderkey AS varchar(30)), '-', cast(l_linenumber AS varchar(30)),
              '-', cast(l_partkey AS varchar(30)), '-', cast(l_suppkey AS varchar(30))) AS url,
       CASE WHEN l_suppkey % 2 = 0 THEN 'board_a' ELSE 'board_b' END AS source_platform,
       concat(p_name, ' ', CASE p_partkey % 8 WHEN 0 THEN 'data engineer' WHEN 1 THEN 'data analyst / data engineer'
              WHEN 2 THEN 'kỹ sư dữ liệu' WHEN 3 THEN 'ba (it)' WHEN 4 THEN 'machine  learning'
              WHEN 5 THEN 'power bi' WHEN 6 THEN 'accountant' ELSE 'Data Scientist' END) AS title,
       c_name AS company,
       CASE WHEN l_suppkey % 5 = 0 THEN NULL
            ELSE concat('https://img.example/', cast(l_suppkey AS varchar(30)), '.png') END AS logo_url,
       CASE l_suppkey % 6 WHEN 0 THEN 'Hồ Chí Minh' WHEN 1 THEN 'Hà Nội (mới) & Đà Nẵng' WHEN 2 THEN 'Hà Nội - HCM'
            WHEN 3 THEN 'nơi khác' WHEN 4 THEN NULL ELSE 'Bình Dương' END AS working_location,
       CASE l_linenumber % 6
            WHEN 0 THEN concat(cast(cast(l_quantity AS int) AS varchar(9)), ' - ',
                               cast(cast(l_quantity AS int) + 10 AS varchar(9)), ' triệu')
            WHEN 1 THEN concat('Từ ', cast(cast(l_quantity AS int) AS varchar(9)), ' triệu')
            WHEN 2 THEN concat('Tới ', cast(cast(l_quantity AS int) AS varchar(9)), ' triệu')
            WHEN 3 THEN 'Thoả thuận' WHEN 4 THEN '1,000 - 2,000 USD' ELSE NULL END AS salary,
       CASE l_partkey % 7 WHEN 0 THEN '2-4 năm' WHEN 1 THEN 'ít nhất 2 năm' WHEN 2 THEN 'dưới 1 năm'
            WHEN 3 THEN '3+ years' WHEN 4 THEN '5 năm' WHEN 5 THEN '2 – 3 năm' ELSE 'không yêu cầu' END AS experiences,
       CASE l_orderkey % 5 WHEN 0 THEN 'Đại học trở lên' WHEN 1 THEN 'Cao đẳng' WHEN 2 THEN 'Master degree'
            WHEN 3 THEN 'PhD' ELSE NULL END AS level_of_education,
       CASE l_linenumber % 4 WHEN 0 THEN 'Hybrid' WHEN 1 THEN 'từ xa' WHEN 2 THEN 'at office' ELSE 'khác' END AS work_model,
       CASE l_orderkey % 3 WHEN 0 THEN 'toàn thời gian' WHEN 1 THEN 'Part time' ELSE 'intern' END AS work_arrangement,
       p_brand AS job_category,
       CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_type END AS tags,
       concat('Reports for ', c_name, ' about ', p_type, ' & data/tools') AS descriptions,
       (l_returnflag = 'R') AS posted_to_discord, l_shipdate AS created_at
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey
"""


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = {n: table(spark, sf_dir, n) for n in ("orders", "part", "customer")}
    views["lineitem"] = table(spark, sf_dir, "lineitem", spread=("l_orderkey", "l_linenumber", "l_partkey"))
    sql = POSTINGS
    for name in views:
        sql = sql.replace(f"FROM {name} ", f"FROM {{{name}}} ").replace(f"JOIN {name} ", f"JOIN {{{name}}} ")
    return spark.sql(sql, **views)


def postings_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The postings written once, for models that pass over them several times."""
    return settled(spark, "postings", lambda: postings(spark, sf_dir))


def staging_a(spark: SparkSession, sf_dir: str, posted: DataFrame | None = None) -> DataFrame:
    wanted = F.concat_ws(" ", "level_of_education", "experiences").alias("requirements_and_experiences")
    posted = postings(spark, sf_dir) if posted is None else posted
    return posted.filter("source_platform = 'board_a'").select(
        "id", "title", "company", "logo_url", "url", "job_category", "working_location", "work_model", "tags",
        "descriptions", wanted, "posted_to_discord", "created_at",
    )


def staging_b(spark: SparkSession, sf_dir: str, posted: DataFrame | None = None) -> DataFrame:
    wanted = F.concat(F.lit("Needs "), F.col("experiences")).alias("requirements")
    posted = postings(spark, sf_dir) if posted is None else posted
    return posted.filter("source_platform = 'board_b'").select(
        "id", "title", "company", "logo_url", "url", "job_category", "working_location", "salary", "descriptions",
        wanted, "experiences", "level_of_education", F.col("work_arrangement").alias("work_model"),
        "posted_to_discord", "created_at",
    )


def logos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known logos: one per supplier in credit."""
    supplier = table(spark, sf_dir, "supplier").filter("s_acctbal > 0")
    url = F.concat(F.lit("https://img.example/"), F.col("s_suppkey").cast("string"), F.lit(".png"))
    return supplier.select(url.alias("logo_url"), F.col("s_name").alias("logo_path")).select(
        logo_key("logo_url").alias("logo_id"), "logo_url", "logo_path"
    )


def bronze_a(spark, sf_dir, posted=None):
    return stg_board_a_jobs(staging_a(spark, sf_dir, postings_table(spark, sf_dir) if posted is None else posted))


def bronze_b(spark, sf_dir, posted=None):
    return stg_board_b_jobs(staging_b(spark, sf_dir, postings_table(spark, sf_dir) if posted is None else posted))


def silver_a(spark, sf_dir, posted=None):
    return silver.int_board_a_jobs(bronze_a(spark, sf_dir, posted))


def silver_b(spark, sf_dir, posted=None):
    return silver.int_board_b_jobs(bronze_b(spark, sf_dir, posted))


def unified(spark, sf_dir, posted=None, boards=None):
    load_time = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    posted = postings_table(spark, sf_dir) if posted is None else posted
    crawled = materialise(posted.select("working_location").distinct(), "places")
    places = crawled.select(normal_location(bronze_place("working_location")).alias("working_location"))
    boards = boards or (silver_a(spark, sf_dir, posted), silver_b(spark, sf_dir, posted))
    return silver.int_jobs_unified(*boards, logos(spark, sf_dir), load_time=load_time, places=places)


def fact(spark, sf_dir):
    return gold.fct_jobs(unified(spark, sf_dir))


# Silver columns that only some reports read.
RARELY_READ = (
    "descriptions", "requirements", "year_of_experiences_raw", "year_of_experiences_normalized",
    "year_of_experiences", "experiences_level", "tags", "salary", "job_title", "logo_id", "job_posted_timestamp",
)


def _stripped(spark, sf_dir, also):
    return unified(spark, sf_dir).drop(*[c for c in RARELY_READ if c not in also])


def unified_table(spark, sf_dir, *also):
    """The silver table written once, for models that read it several times; its ids are made anew from what is written."""
    jobs = settled(spark, "int_jobs_unified", lambda: _stripped(spark, sf_dir, also).drop("job_id"))
    return jobs.select(surrogate_key("source_platform", "url").alias("job_id"), *jobs.columns)


def wanted_table(spark, sf_dir, *also, ids=True):
    """What gold reads of the silver table (rows with a category), written once for a report's dimension, fact and totals;
    `ids` for reports that count job ids."""

    def wanted() -> DataFrame:
        rows = gold.categorised(_stripped(spark, sf_dir, also))
        return rows if ids else rows.drop("job_id")

    return settled(spark, "int_jobs_wanted", wanted)


# ---- the checking side: the same steps in DuckDB SQL ----------------------------------------

WORD = r"[\p{L}\p{M}\p{Nd}_]"


def initcap_sql(c: str) -> str:
    pieces = f"regexp_extract_all(lower(trim({c})), '{WORD}+|[^\\p{{L}}\\p{{M}}\\p{{Nd}}_]+')"
    # a sharp s has no single upper-case letter and stays as it is
    return f"array_to_string([concat(CASE x[1] WHEN 'ß' THEN 'ß' ELSE upper(x[1]) END, x[2:]) for x in {pieces}], '')"


def key_sql(*parts: str) -> str:
    return "upper(md5(" + " || '|' || ".join(parts) + "))"


# The words, patterns and labels in the CASE lists below must be what the models give.


def extract_sql(c: str) -> str:
    span = r"\d+\s*(?:-|–|đến|to)\s*\d+\+?"
    years = r"(?:năm|years?)"
    below, least = "(?:dưới|below|less than)", "(?:tối thiểu|ít nhất|trên|at least|minimum)"
    return rf"""CASE
      WHEN regexp_matches({c}, '(?i){span}\s*{years}') THEN nullif(regexp_extract({c}, '(?i)({span})\s*{years}', 1), '')
      WHEN regexp_matches({c}, '(?i)\d+\s*\+\s*(?:năm|years|year?)')
        THEN nullif(regexp_extract({c}, '(?i)(\d+\s*\+)\s*{years}', 1), '')
      WHEN regexp_matches({c}, '(?i){below}\s*\d+\s*{years}')
        THEN nullif(regexp_extract({c}, '(?i){below}\s*(\d+)\s*{years}', 1), '') || '-'
      WHEN regexp_matches({c}, '(?i){least}\s*\d+\s*{years}')
        THEN nullif(regexp_extract({c}, '(?i){least}\s*(\d+)\s*{years}', 1), '') || '+'
      WHEN regexp_matches({c}, '(?i)\d+\s*{years}') THEN nullif(regexp_extract({c}, '(?i)(\d+)\s*{years}', 1), '')
      ELSE 'Unknown' END"""


def years_sql(c: str) -> str:
    t = f"replace(replace(lower({c}), '–', '-'), '—', '-')"
    low = f"try_cast(regexp_extract({t}, '^([0-9]+)', 1) AS DOUBLE)"
    high = f"try_cast(regexp_extract({t}, '-([0-9]+)', 1) AS DOUBLE)"
    return f"""CASE WHEN regexp_matches({t}, '^[0-9]+[+]?$') THEN {low}
      WHEN regexp_matches({t}, '^[0-9]+-$') THEN {low} / 2
      WHEN regexp_matches({t}, '^[0-9]+-[0-9]+[+]?$') THEN ({low} + {high}) / 2 END"""


def years_band_sql(n: str) -> str:
    return f"""CASE WHEN {n} IS NULL THEN 'Unknown' WHEN {n} < 1 THEN '0-1 year' WHEN {n} < 3 THEN '1-3 years'
      WHEN {n} < 5 THEN '3-5 years' WHEN {n} < 8 THEN '5-8 years' ELSE '8+ years' END"""


def years_level_sql(n: str) -> str:
    return f"""CASE WHEN {n} IS NULL THEN 'Unknown' WHEN {n} < 1 THEN 'Intern / Fresher' WHEN {n} < 3 THEN 'Junior'
      WHEN {n} < 5 THEN 'Mid-level' WHEN {n} < 8 THEN 'Senior' ELSE 'Lead / Principal' END"""


def education_sql(c: str) -> str:
    return f"""CASE WHEN lower({c}) LIKE '%cao đẳng%' OR lower({c}) LIKE '%college%' THEN 'College'
      WHEN lower({c}) LIKE '%đại học%' OR lower({c}) LIKE '%bachelor%' THEN 'Bachelor'
      WHEN lower({c}) LIKE '%thạc sĩ%' OR lower({c}) LIKE '%master%' THEN 'Master'
      WHEN lower({c}) LIKE '%tiến sĩ%' OR lower({c}) LIKE '%phd%' THEN 'PhD' ELSE 'Unknown' END"""


def bound_sql(c: str, side: str) -> str:
    group, word = (1, "từ") if side == "min" else (2, "(?:upto|tới)")
    return rf"""CASE WHEN regexp_matches(lower({c}), '^\s*\d+\s*-\s*\d+')
        THEN try_cast(regexp_extract({c}, '(\d+)\s*-\s*(\d+)', {group}) AS INTEGER)
      WHEN regexp_matches(lower({c}), '{word}\s*\d+')
        THEN try_cast(regexp_extract(lower({c}), '{word}\s*(\d+)', 1) AS INTEGER) END::BIGINT
      * CASE WHEN lower({c}) LIKE '%usd%' THEN 24000 ELSE 1000000 END"""


def value_sql(low: str, high: str) -> str:
    return f"""CASE WHEN {low} IS NOT NULL AND {high} IS NOT NULL THEN round(({low} + {high}) / 2.0, 1)
      ELSE coalesce({low}, {high}) END::DOUBLE"""


def bench_sql(v: str) -> str:
    inner = " ".join(f"WHEN {v} < {i + 1}0000000 THEN '{i}0-{i + 1}0M VND'" for i in range(1, 10))
    return f"""CASE WHEN {v} < 10000000 THEN 'Below 10M VND' {inner} WHEN {v} >= 100000000 THEN 'Above 100M VND'
      ELSE 'Not Specified' END"""


def work_model_sql(c: str) -> str:
    low = f"lower(trim({c}))"
    return f"""CASE WHEN {low} IN ('hybrid', 'lai') THEN 'Hybrid' WHEN {low} IN ('remote', 'từ xa') THEN 'Remote'
      WHEN {low} IN ('at office', 'tại văn phòng', 'on-site', 'on site') THEN 'On-Site' ELSE trim({c}) END"""


def arrangement_sql(c: str) -> str:
    low = f"lower(trim({c}))"
    return f"""CASE WHEN {low} IN ('toàn thời gian', 'full-time', 'full time', 'fulltime') THEN 'Full-time'
      WHEN {low} IN ('bán thời gian', 'part-time', 'part time') THEN 'Part-time'
      WHEN {low} IN ('thực tập', 'internship', 'intern') THEN 'Internship' ELSE trim({c}) END"""


def _values(rows) -> str:
    return ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)


def _ctes() -> list[tuple[str, str]]:
    from postlens import fixed_values as fv

    stg_common = f"""id AS source_job_id, {initcap_sql('title')} AS title, upper(trim(company)) AS company,
      trim(logo_url) AS logo_url, trim(url) AS url, job_category, {initcap_sql('working_location')} AS working_location"""
    place = "trim(replace(replace(lower(b.working_location), '(mới)', ''), '&', '-')) AS working_location"
    dated = "b.posted_to_discord, b.created_at::DATE AS job_posted_date, b.created_at AS job_posted_timestamp"
    category = "coalesce(m.target, 'Others') AS job_category"
    on = "FROM {} b LEFT JOIN categories m ON regexp_matches(lower(b.title), m.pattern)"
    fact_columns = ", ".join(gold.FACT_COLUMNS)
    return [
        ("postings", POSTINGS),
        (
            "staging_a",
            """SELECT id, title, company, logo_url, url, job_category, working_location, work_model, tags, descriptions,
               concat_ws(' ', level_of_education, experiences) AS requirements_and_experiences,
               posted_to_discord, created_at FROM postings WHERE source_platform = 'board_a'""",
        ),
        (
            "staging_b",
            """SELECT id, title, company, logo_url, url, job_category, working_location, salary, descriptions,
               'Needs ' || experiences AS requirements, experiences, level_of_education, work_arrangement AS work_model,
               posted_to_discord, created_at FROM postings WHERE source_platform = 'board_b'""",
        ),
        (
            "logos",
            """SELECT md5(logo_url) AS logo_id, logo_url, logo_path FROM
               (SELECT concat('https://img.example/', s_suppkey::VARCHAR, '.png') AS logo_url, s_name AS logo_path
                FROM supplier WHERE s_acctbal > 0)""",
        ),
        ("categories", f"SELECT * FROM (VALUES {_values(fv.CATEGORY_PATTERNS)}) t(pattern, target)"),
        ("cities", f"SELECT * FROM (VALUES {_values(fv.CITY_PATTERNS)}) t(pattern, city_code, city_en, region)"),
        (
            "bronze_a",
            f"""SELECT {stg_common}, {initcap_sql('work_model')} AS work_model, {initcap_sql('tags')} AS tags,
                lower(trim(descriptions)) AS descriptions,
                lower(trim(requirements_and_experiences)) AS requirements_and_experiences, posted_to_discord, created_at
                FROM staging_a""",
        ),
        (
            "bronze_b",
            f"""SELECT {stg_common}, replace({initcap_sql('salary')}, ',', '') AS salary,
                lower(trim(descriptions)) AS descriptions, lower(trim(requirements)) AS requirements,
                lower(trim(experiences)) AS experiences, {initcap_sql('level_of_education')} AS level_of_education,
                {initcap_sql('work_model')} AS work_model, posted_to_discord, created_at FROM staging_b""",
        ),
        (
            "silver_a",
            f"""SELECT 'board_a' AS source_platform, b.url, b.logo_url, b.title, b.company, {place},
                'Full-time' AS work_arrangement, b.work_model, NULL::VARCHAR AS salary, {category},
                NULL::BIGINT AS salary_min_million, NULL::BIGINT AS salary_max_million,
                {education_sql('b.requirements_and_experiences')} AS education_requirement, b.descriptions,
                b.requirements_and_experiences AS requirements,
                {extract_sql('b.requirements_and_experiences')} AS year_of_experiences, b.tags, {dated}
                {on.format('bronze_a')}""",
        ),
        (
            "silver_b",
            f"""SELECT 'board_b' AS source_platform, b.url, b.logo_url, b.title, b.company, {place},
                b.work_model AS work_arrangement, 'On-Site' AS work_model, b.salary, {category},
                {bound_sql('b.salary', 'min')} AS salary_min_million, {bound_sql('b.salary', 'max')} AS salary_max_million,
                {education_sql('b.level_of_education')} AS education_requirement, b.descriptions, b.requirements,
                {extract_sql('b.experiences')} AS year_of_experiences, b.job_category AS tags, {dated}
                {on.format('bronze_b')}""",
        ),
        (
            "exploded",
            """SELECT * EXCLUDE (working_location, place), trim(place) AS working_location FROM
               (SELECT *, unnest(string_split(working_location, '-')) AS place FROM
                (SELECT * FROM silver_a UNION ALL BY NAME SELECT * FROM silver_b))
               WHERE place NOT LIKE '%nơi khác%'""",
        ),
        (
            "valued",
            f"""SELECT e.*, c.city_en, l.logo_id, {value_sql('salary_min_million', 'salary_max_million')} AS average,
                {years_sql('year_of_experiences')} AS years
                FROM exploded e LEFT JOIN cities c ON regexp_matches(e.working_location, c.pattern)
                LEFT JOIN logos l ON e.logo_url = l.logo_url""",
        ),
        (
            "unified",
            f"""SELECT {key_sql('source_platform', 'url')} AS job_id, source_platform, url, logo_id, title AS job_title,
                company AS company_name, trim(city_en) AS job_location, job_category,
                {work_model_sql('work_model')} AS work_model_normalized,
                {arrangement_sql('work_arrangement')} AS work_arrangement_normalized, salary, salary_min_million,
                salary_max_million, average AS salary_avg_million, {bench_sql('average')} AS salary_band,
                education_requirement, descriptions, requirements, year_of_experiences AS year_of_experiences_raw,
                years AS year_of_experiences_normalized, {years_band_sql('years')} AS year_of_experiences,
                {years_level_sql('years')} AS experiences_level, tags, posted_to_discord, job_posted_date,
                job_posted_timestamp, TIMESTAMP '2024-01-01 00:00:00' AS dbt_load_timestamp FROM valued""",
        ),
        ("wanted", "SELECT * FROM unified WHERE job_category IS NOT NULL AND job_category <> 'Others'"),
        (
            "fact",
            f"""SELECT job_id, {key_sql('job_category')} AS job_category_id,
                {key_sql('source_platform', 'company_name')} AS company_id,
                {key_sql('work_model_normalized')} AS work_model_id, {key_sql('job_location')} AS location_id,
                {key_sql('education_requirement')} AS education_id, {key_sql('salary_band')} AS salary_band_id,
                {fact_columns} FROM wanted""",
        ),
    ]


def cte_names() -> list[str]:
    return [name for name, _ in _ctes()]


def with_ctes(final: str, upto: str = "fact", materialized: bool = False) -> str:
    """`final` preceded by the CTEs down to `upto`, each of them computed once if `materialized`."""
    parts = []
    for name, body in _ctes():
        parts.append(f"{name} AS {'MATERIALIZED ' if materialized else ''}({body})")
        if name == upto:
            break
    return "WITH " + ",\n".join(parts) + "\n" + final
