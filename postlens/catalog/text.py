"""Text normalisation, salary, experience, labels and request reading."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlens import fixed_values as fv
from postlens.catalog import fixture as fx
from postlens.catalog.fixture import initcap_sql, key_sql, with_ctes
from postlens.catalog.registry import query, table
from postlens.functions import experience, labels, requests, salary, text
from postlens.operators import chunks
from postlens.plans import alerts, retrieval


def _sql(select: str) -> str:
    return with_ctes(f"SELECT url, {select} FROM postings", "postings")


@query(
    "clean_text",
    _sql(
        """lower(trim(title)) AS low, upper(trim(company)) AS up, replace(salary, ',', '') AS plain,
           trim(replace(replace(lower(working_location), '(mới)', ''), '&', '-')) AS place"""
    ),
)
def clean_text(spark, sf_dir):
    return fx.postings(spark, sf_dir).select(
        "url",
        text.lower_trim("title").alias("low"),
        text.upper_trim("company").alias("up"),
        text.strip_commas("salary").alias("plain"),
        text.normal_location("working_location").alias("place"),
    )


@query("initcap_words", f"SELECT doc_id, {initcap_sql('text')} AS words FROM documents")
def initcap_words(spark, sf_dir):
    documents = table(spark, sf_dir, "documents", spread=("doc_id",))
    return documents.select("doc_id", text.initcap_trim("text").alias("words"))


@query(
    "surrogate_keys",
    _sql(
        f"""{key_sql('source_platform', 'url')} AS job_id, {key_sql('source_platform', 'company')} AS company_id,
            {key_sql('level_of_education')} AS education_id, md5(logo_url) AS logo_id"""
    ),
)
def surrogate_keys(spark, sf_dir):
    return fx.postings(spark, sf_dir).select(
        "url",
        text.surrogate_key("source_platform", "url").alias("job_id"),
        text.surrogate_key("source_platform", "company").alias("company_id"),
        text.surrogate_key("level_of_education").alias("education_id"),
        text.logo_key("logo_url").alias("logo_id"),
    )


LOW, HIGH = fx.bound_sql("plain", "min"), fx.bound_sql("plain", "max")
BOUNDS = with_ctes(
    f"""SELECT url, low, high, {fx.value_sql('low', 'high')} AS value FROM
        (SELECT url, {LOW} AS low, {HIGH} AS high FROM (SELECT url, replace(salary, ',', '') AS plain FROM postings))""",
    "postings",
)


def _bounds(spark, sf_dir):
    plain = fx.postings(spark, sf_dir).select("url", text.strip_commas("salary").alias("plain"))
    rows = plain.select("url", salary.min_salary("plain").alias("low"), salary.max_salary("plain").alias("high"))
    return rows.withColumn("value", salary.salary_value("low", "high"))


@query("salary_min_max", BOUNDS)
def salary_min_max(spark, sf_dir):
    return _bounds(spark, sf_dir)


@query("salary_band", f"SELECT url, {fx.bench_sql('value')} AS band FROM ({BOUNDS})")
def salary_band(spark, sf_dir):
    return _bounds(spark, sf_dir).select("url", salary.salary_bench("value").alias("band"))


@query(
    "salary_band_label",
    f"""SELECT url, CASE WHEN low IS NULL AND high IS NULL THEN 'Not Specified'
          WHEN low IS NULL THEN concat(greatest(high - 10000000, 0) // 1000000, '-', high, 'M VND')
          WHEN high IS NULL THEN concat(low // 1000000, '-', (low + 10000000) // 1000000, 'M VND')
          ELSE concat(low // 1000000, '-', high // 1000000, 'M VND') END AS label FROM ({BOUNDS})""",
)
def salary_band_label(spark, sf_dir):
    return _bounds(spark, sf_dir).select("url", salary.salary_band_label("low", "high").alias("label"))


@query("experience_extract", _sql(f"{fx.extract_sql('experiences')} AS years"))
def experience_extract(spark, sf_dir):
    return fx.postings(spark, sf_dir).select("url", experience.extract_experience("experiences").alias("years"))


@query(
    "experience_band",
    with_ctes(
        f"""SELECT url, n, {fx.years_band_sql('n')} AS band, {fx.years_level_sql('n')} AS level FROM
            (SELECT url, {fx.years_sql('y')} AS n FROM
             (SELECT url, {fx.extract_sql('experiences')} AS y FROM postings))""",
        "postings",
    ),
)
def experience_band(spark, sf_dir):
    jobs = fx.postings(spark, sf_dir).select("url", experience.extract_experience("experiences").alias("y"))
    jobs = jobs.select("url", experience.years_normalized("y").alias("n"))
    return jobs.select("*", experience.years_band("n").alias("band"), experience.years_level("n").alias("level"))


@query("education_level", _sql(f"{fx.education_sql('level_of_education')} AS level"))
def education_level(spark, sf_dir):
    return fx.postings(spark, sf_dir).select("url", labels.education_level("level_of_education").alias("level"))


@query("work_model", _sql(f"{fx.work_model_sql('work_model')} AS model"))
def work_model(spark, sf_dir):
    return fx.postings(spark, sf_dir).select("url", labels.work_model("work_model").alias("model"))


@query("work_arrangement", _sql(f"{fx.arrangement_sql('work_arrangement')} AS arrangement"))
def work_arrangement(spark, sf_dir):
    return fx.postings(spark, sf_dir).select("url", labels.work_arrangement("work_arrangement").alias("arrangement"))


# ---- requests ------------------------------------------------------------------------------


@query("fold_accents", "SELECT conv_id, turn, strip_accents(lower(text)) AS folded FROM conversations")
def fold_accents(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.fold_accents("text").alias("folded"))


NUMBERS = "regexp_extract_all(t, '\\d+(?:[,.]\\d+)?')"
FROM_TEXT = f"""CASE WHEN t LIKE '%thoa thuan%' OR t LIKE '%canh tranh%' OR t LIKE '%negotiable%' THEN NULL
  ELSE list_max([replace(n, ',', '.')::DOUBLE for n in {NUMBERS}])
       * CASE WHEN t LIKE '%usd%' OR t LIKE '%$%' THEN 25.0::DOUBLE / 1000 ELSE 1 END END"""


@query(
    "salary_from_text",
    with_ctes(f"SELECT url, {FROM_TEXT} AS millions FROM (SELECT url, strip_accents(lower(salary)) AS t FROM postings)", "postings"),
)
def salary_from_text(spark, sf_dir):
    return fx.postings(spark, sf_dir).select("url", salary.salary_from_text("salary").alias("millions"))


@query(
    "salary_sort",
    with_ctes(
        f"""SELECT url, coalesce(greatest(p_max, p_avg, {FROM_TEXT}), -1)::DOUBLE AS sort_value,
            row_number() OVER (ORDER BY coalesce(greatest(p_max, p_avg, {FROM_TEXT}), -1) DESC, url) AS position
            FROM (SELECT url, strip_accents(lower(salary)) AS t, CASE WHEN level_of_education = 'PhD' THEN 12.5 END::DOUBLE AS p_max,
                  NULL::DOUBLE AS p_avg FROM postings)""",
        "postings",
    ),
)
def salary_sort(spark, sf_dir):
    from postlens.operators.ranking import rank_many

    jobs = fx.postings(spark, sf_dir)
    high = F.when(F.col("level_of_education") == "PhD", F.lit("12,5"))
    value = salary.salary_sort_value(high, F.lit(""), "salary")
    rows = jobs.select("url", value.alias("sort_value"))
    return rank_many(rows, [F.col("sort_value").desc(), F.col("url").asc()], "position")


MESSAGE = "concat(CASE WHEN conv_id % 2 = 0 THEN role ELSE '' END, CASE turn % 5 WHEN 0 THEN ' cho tôi 2 job lương cao nhất' WHEN 1 THEN ' kiếm job data analyst' " \
    "WHEN 2 THEN ' top 7 highest salary' WHEN 3 THEN ' hai việc lương cao' ELSE ' ba job' END)"
COUNT_SQL = "coalesce(" + ", ".join(
    [f"try_cast(nullif(regexp_extract(t, '{p}', 1), '') AS INTEGER)" for p in fv.COUNT_PATTERNS]
    + [f"CASE WHEN regexp_matches(t, '\\b{w}\\s+(?:{fv.JOB_NOUNS})\\b') THEN {n} END" for w, n in fv.NUMBER_WORDS]
) + ")"


def _like(terms) -> str:
    return "(" + " OR ".join(f"t LIKE '%{t}%'" for t in terms) + ")"


def _broad_sql() -> str:
    rest = "regexp_replace(t, '\\b\\d{1,2}\\b', ' ', 'g')"
    for term in fv.FILLER_TERMS:
        rest = f"regexp_replace({rest}, '\\b{term}\\b', ' ', 'g')"
    return f"trim({rest}) = ''"


PLAN_SQL = f"""SELECT conv_id, turn, response_limit, CASE WHEN by_salary THEN greatest(50, response_limit)
    ELSE response_limit END AS retrieval_limit, by_salary AS salary_sort_desc, by_salary AND broad AS scan_salary_collection
  FROM (SELECT conv_id, turn, least(coalesce(nullif({COUNT_SQL}, 0), 5), 10) AS response_limit,
          {_like(fv.SALARY_TERMS)} AND {_like(fv.HIGH_TERMS)} AS by_salary, {_broad_sql()} AS broad
        FROM (SELECT conv_id, turn, strip_accents(lower({MESSAGE})) AS t FROM conversations))"""


def messages(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.expr(MESSAGE).alias("message"))


@query("query_plan", PLAN_SQL)
def query_plan(spark, sf_dir):
    return retrieval.plan_requests(messages(spark, sf_dir)).drop("message")


@query("query_plan_texts", PLAN_SQL.replace(MESSAGE, "text"))
def query_plan_texts(spark, sf_dir):
    """The same over the conversations as they are."""
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("message"))
    return retrieval.plan_requests(talk).drop("message")


# ---- messages ------------------------------------------------------------------------------


def _alert_sql(board: str, salary: str) -> str:
    return f"""SELECT trim(title) AS title, url, CASE WHEN logo_url <> '' THEN trim(logo_url) END AS thumbnail,
        CASE WHEN working_location <> '' THEN trim(working_location) END AS location,
        {salary} AS salary FROM staging_{board} WHERE NOT posted_to_discord"""


@query(
    "alert_records",
    with_ctes(
        _alert_sql("a", "'Sign-in for details.'")
        + " UNION ALL "
        + _alert_sql("b", "CASE WHEN salary <> '' THEN salary ELSE 'Negotiable' END"),
        "staging_b",
    ),
)
def alert_records(spark, sf_dir):
    a = alerts.pending_jobs(fx.staging_a(spark, sf_dir), "Sign-in for details.")
    b = alerts.pending_jobs(fx.staging_b(spark, sf_dir))
    return alerts.alert_records(a.unionByName(b))


@query(
    "chunk_text",
    r"""
    WITH RECURSIVE lines AS (
        SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i
        FROM (SELECT doc_id, regexp_split_to_array(regexp_replace(text, '\n$', ''), '\n') AS l
              FROM documents WHERE length(text) > 1900)),
    pieces AS (
        SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i, beg) AS n, substr(line, beg, 1900) AS piece
        FROM (SELECT doc_id, i, line, unnest(range(1, greatest(length(line), 1) + 1, 1900)) AS beg FROM lines)),
    packed AS (
        SELECT doc_id, n, 0 AS part, piece AS open FROM pieces WHERE n = 1
        UNION ALL
        SELECT p.doc_id, p.n,
               CASE WHEN k.open = '' OR length(k.open) + 1 + length(p.piece) <= 1900 THEN k.part ELSE k.part + 1 END,
               CASE WHEN k.open <> '' AND length(k.open) + 1 + length(p.piece) <= 1900
                    THEN k.open || chr(10) || p.piece ELSE p.piece END
        FROM packed k JOIN pieces p ON p.doc_id = k.doc_id AND p.n = k.n + 1)
    SELECT doc_id, part, arg_max(open, n) AS chunk FROM packed WHERE open <> '' GROUP BY doc_id, part
    UNION ALL
    SELECT doc_id, 0, text FROM documents WHERE length(text) <= 1900
    """,
)
def chunk_text(spark, sf_dir):
    return chunks.chunk_text(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")


@query(
    "page_preview",
    r"""SELECT page_id, CASE WHEN length(h) > 500 THEN h[1:500] || '...' ELSE h END AS preview
        FROM (SELECT page_id, trim(regexp_replace(html, '[\s\p{Z}\x{85}\x{0B}\x{1C}-\x{1F}]+', ' ', 'g')) AS h FROM pages)""",
)
def page_preview(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.preview("html").alias("preview"))
