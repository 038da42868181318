"""Embedding, nearest neighbours, retrieval, prompts and the audit of task runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlens import fixed_values as fv
from postlens.catalog import fixture as fx
from postlens.catalog.fixture import with_ctes
from postlens.catalog.registry import query, table
from postlens.catalog.text import MESSAGE, PLAN_SQL, messages
from postlens.operators.vectors import cosine_topk, embed_text
from postlens.plans import audit, embedding, gold, retrieval

# ---- text to embed -------------------------------------------------------------------------

PARTS = " || '. ' || ".join(f"'{label}: ' || coalesce({c}::VARCHAR, '')" for label, c in fv.EMBEDDING_PARTS)
MAXES = ", ".join(f"max(f.{c}) AS {c}" for c in embedding.MAX_COLUMNS)
VECTOR_DB = f"""
SELECT * EXCLUDE (dbt_load_timestamp, descriptions, requirements, education_requirement), education_requirement,
  {PARTS} AS embedding_text FROM (
  SELECT f.job_id, string_agg(DISTINCT f.job_location, ', ' ORDER BY f.job_location)
      FILTER (WHERE trim(f.job_location) <> '') AS job_locations, {MAXES},
    max(c.descriptions) AS descriptions, max(c.requirements) AS requirements
  FROM fact f LEFT JOIN (SELECT job_id, max(descriptions) AS descriptions, max(requirements) AS requirements
    FROM unified GROUP BY job_id) c ON f.job_id = c.job_id {{where}} GROUP BY f.job_id)
WHERE trim(coalesce(job_title, '') || coalesce(company_name, '') || coalesce(descriptions, '') || coalesce(requirements, '')) <> ''"""


def _vector_db(spark, sf_dir, existing=None):
    jobs = fx.unified_table(spark, sf_dir, *fx.RARELY_READ)
    return embedding.vector_db(gold.fct_jobs(jobs), jobs, existing)


@query("embedding_text", with_ctes(VECTOR_DB.format(where="")))
def embedding_text(spark, sf_dir):
    return _vector_db(spark, sf_dir).drop("dbt_load_timestamp")


@query("vector_db_incremental", with_ctes(VECTOR_DB.format(where="WHERE f.source_platform <> 'board_a'")))
def vector_db_incremental(spark, sf_dir):
    """Board A is in the table already; the postings of board B are new."""
    from postlens.functions.text import surrogate_key

    known = fx.staging_a(spark, sf_dir).select(surrogate_key(F.lit("board_a"), "url").alias("job_id"))
    return _vector_db(spark, sf_dir, known).drop("dbt_load_timestamp")


def _batch(spark, sf_dir):
    """Documents as a batch to embed; some ids are blank and the language texts repeat ids."""
    documents = table(spark, sf_dir, "documents")
    key = F.when(F.col("n_chars") % 11 == 0, " ").otherwise((F.col("doc_id") / 2).cast("bigint").cast("string"))
    return documents.select(key.alias("job_id"), F.col("text").alias("embedding_text"), "doc_id")


def _collection(spark, sf_dir):
    return table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("job_id"))


BATCH_SQL = """(SELECT CASE WHEN n_chars % 11 = 0 THEN ' ' ELSE (doc_id // 2)::VARCHAR END AS job_id, text, doc_id FROM documents)"""
VALID_SQL = f"(SELECT DISTINCT job_id FROM {BATCH_SQL} WHERE trim(job_id) <> '' AND trim(text) <> '')"
KNOWN_SQL = "(SELECT doc_id::VARCHAR FROM labels)"


@query(
    "embed_accounting",
    f"""SELECT (SELECT count(*) FROM documents) AS received,
          count(*) FILTER (WHERE job_id NOT IN {KNOWN_SQL}) AS embedded,
          count(*) FILTER (WHERE job_id IN {KNOWN_SQL}) AS skipped_existing,
          (SELECT count(*) FROM documents) - count(*) AS skipped_invalid FROM {VALID_SQL}""",
)
def embed_accounting(spark, sf_dir):
    return embedding.embed_accounting(_batch(spark, sf_dir), _collection(spark, sf_dir))


@query(
    "embed_new_rows",
    f"""SELECT job_id, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY trim(job_id) ORDER BY doc_id) AS rn
        FROM {BATCH_SQL} WHERE trim(job_id) <> '' AND trim(text) <> '') WHERE rn = 1 AND job_id NOT IN {KNOWN_SQL}""",
)
def embed_new_rows(spark, sf_dir):
    rows = embedding.rows_to_embed(_batch(spark, sf_dir), _collection(spark, sf_dir), F.col("doc_id"))
    return rows.select("job_id", "doc_id")


# Hashed terms of a text in SQL: (id, place, weight) of the places that are not empty.
TERMS = """SELECT {id} AS id, place, n / sqrt(sum(n * n) OVER (PARTITION BY {id})) AS weight FROM (
  SELECT {id}, (('0x' || right(md5(word), 7))::BIGINT % 256)::INTEGER AS place, count(*)::DOUBLE AS n
  FROM (SELECT {id}, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]+')) AS word FROM {table}) GROUP BY ALL)"""


@query(
    "embed_documents",
    "SELECT id AS doc_id, place, round(weight::FLOAT::DOUBLE, 6) AS weight FROM ("
    + TERMS.format(id="doc_id", text="text", table="documents")
    + ")",
)
def embed_documents(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    places = embed_text(documents, "text").select("doc_id", F.posexplode("embedding").alias("place", "weight"))
    return places.filter("weight > 0").withColumn("weight", F.round(F.col("weight").cast("double"), 6))


# ---- nearest neighbours and retrieval ------------------------------------------------------


NEAREST_SQL = """SELECT query_id, item_id, distance, rank::INTEGER AS rank FROM (
         SELECT query_id, item_id, abs(round(whole, 6)) AS distance,
           row_number() OVER (PARTITION BY query_id ORDER BY whole, item_id) AS rank FROM (
           SELECT q.vec_id AS query_id, i.vec_id AS item_id,
             1 - list_cosine_similarity(q.embedding::DOUBLE[], i.embedding::DOUBLE[]) AS whole
           FROM embeddings q CROSS JOIN embeddings i)) WHERE rank <= 5"""


def _neighbours(spark, sf_dir, **how):
    vectors = table(spark, sf_dir, "embeddings")
    queries = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    items = vectors.select(F.col("vec_id").alias("item_id"), "embedding")
    return cosine_topk(queries, items, 5, **how)


@query("cosine_topk", NEAREST_SQL)
def nearest(spark, sf_dir):
    return _neighbours(spark, sf_dir)


@query("cosine_topk_index", NEAREST_SQL)
def nearest_by_index(spark, sf_dir):
    """The same neighbours through a metric index, in blocks of 100 rows."""
    return _neighbours(spark, sf_dir, cells=16, block_rows=100)


def _jobs(spark, sf_dir):
    """Embedded postings with their metadata: one per document, salary and place from the fixture's pools."""
    documents = table(spark, sf_dir, "documents", spread=("doc_id",))
    empty = [F.lit(None).cast("string").alias(f) for f in fv.METADATA_FIELDS]
    low = F.col("doc_id") % 60 + 5
    salary = F.when(F.col("doc_id") % 3 == 0, "Thoả thuận").otherwise(F.concat(low.cast("string"), F.lit(" - "), (low * 2).cast("string"), F.lit(" triệu")))
    rows = documents.select(*empty, F.col("text").alias("document"), "doc_id", "source", "lang")
    rows = rows.withColumns(
        {
            "job_id": F.col("doc_id").cast("string"),
            "job_title": F.concat(F.lit("Job "), F.col("doc_id").cast("string")),
            "company_name": F.col("source"),
            "job_locations": F.col("lang"),
            "salary": salary,
            "url": F.concat(F.lit("https://jobs.example/"), F.col("doc_id").cast("string")),
        }
    )
    rows = rows.withColumn("metadata", embedding.metadata())
    rows = rows.select("job_id", "document", "salary", "salary_max_million", "salary_avg_million", "metadata")
    return embed_text(rows, "document")


def _requests(spark, sf_dir):
    talk = messages(spark, sf_dir)
    key = F.concat_ws("-", "conv_id", "turn")
    return embed_text(talk.select(key.alias("query_id"), F.col("conv_id").cast("string").alias("user_id"), "message"), "message")


def _results(spark, sf_dir, document_chars=None):
    """Result records of all requests; `document_chars` cuts documents before they are joined."""
    jobs = _jobs(spark, sf_dir)
    found = retrieval.retrieve(_requests(spark, sf_dir).drop("user_id"), jobs)
    document = F.col("document") if document_chars is None else F.substring("document", 1, document_chars).alias("document")
    return retrieval.result_records(found.join(jobs.select("job_id", document, "metadata"), "job_id"))


def _dense_sql(key: str, text: str, source: str) -> str:
    return f"""SELECT id, [coalesce(m[p], 0::FLOAT)::DOUBLE FOR p IN range(256)] AS v
        FROM (SELECT id, map_from_entries(list((place, weight::FLOAT))) AS m FROM ({TERMS.format(id=key, text=text, table=source)}) GROUP BY id)"""


RETRIEVE = f"""
WITH plans AS (SELECT conv_id || '-' || turn AS query_id, * EXCLUDE (conv_id, turn) FROM ({PLAN_SQL})),
asks AS ({_dense_sql('query_id', 'message', f"(SELECT conv_id || '-' || turn AS query_id, {MESSAGE} AS message FROM conversations)")}),
docs AS ({_dense_sql('job_id', 'text', '(SELECT doc_id::VARCHAR AS job_id, text FROM documents)')}),
pay AS (SELECT doc_id::VARCHAR AS job_id, CASE WHEN doc_id % 3 = 0 THEN -1.0 ELSE (doc_id % 60 + 5) * 2.0 END AS value FROM documents),
near AS (
  SELECT * FROM (SELECT a.id AS query_id, d.id AS job_id, whole, row_number() OVER (PARTITION BY a.id ORDER BY whole, d.id) AS rank
    FROM (SELECT a.id AS a_id, d.id AS d_id, 1 - list_cosine_similarity(a.v, d.v) AS whole FROM asks a CROSS JOIN docs d) c
    JOIN asks a ON a.id = a_id JOIN docs d ON d.id = d_id) WHERE rank <= 50),
found AS (
  SELECT query_id, job_id, position, response_limit, retrieval_limit, 'semantic_search' AS retrieval_mode, salary_sort_desc,
         abs(round(whole, 6)) AS distance
  FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY v >= 0 DESC, v DESC, rank) AS position
        FROM (SELECT n.*, p.* EXCLUDE (query_id), CASE WHEN salary_sort_desc THEN value ELSE 0 END AS v
              FROM near n JOIN plans p USING (query_id) JOIN pay USING (job_id)
              WHERE NOT scan_salary_collection AND rank <= retrieval_limit))
  WHERE position <= response_limit),
top AS (SELECT job_id, row_number() OVER (ORDER BY value >= 0 DESC, value DESC, job_id) AS position FROM pay)
SELECT * REPLACE (position::INTEGER AS position) FROM found UNION ALL
SELECT query_id, job_id, position::INTEGER, response_limit, retrieval_limit, 'salary_collection_scan', salary_sort_desc, NULL
FROM plans JOIN top ON position <= response_limit WHERE scan_salary_collection"""


@query("retrieve", RETRIEVE)
def retrieve(spark, sf_dir):
    return retrieval.retrieve(_requests(spark, sf_dir).drop("user_id"), _jobs(spark, sf_dir))


TITLE, LINK = "concat('Job ', doc_id::VARCHAR)", "concat('https://jobs.example/', doc_id::VARCHAR)"
SALARY = "CASE WHEN doc_id % 3 = 0 THEN 'Thoả thuận' ELSE concat((doc_id % 60 + 5)::VARCHAR, ' - ', (doc_id % 60 + 5) * 2, ' triệu') END"
BLANKS = ", ".join(
    f"'' AS {f}" for f in fv.RESULT_FIELDS if f not in ("title", "company", "locations", "salary", "url")
)
RESULT_SQL = f"""SELECT doc_id::VARCHAR AS job_id, {TITLE} AS title, source AS company, lang AS locations,
  {SALARY} AS salary, {LINK} AS url, {BLANKS}, text AS document FROM documents"""


@query("result_map", RESULT_SQL)
def result_map(spark, sf_dir):
    jobs = _jobs(spark, sf_dir).select("job_id", "document", "metadata")
    return retrieval.result_records(jobs).drop("metadata")


@query("source_links", f"SELECT job_id, title, company, url FROM ({RESULT_SQL}) WHERE url <> ''")
def source_links(spark, sf_dir):
    return retrieval.source_links(retrieval.result_records(_jobs(spark, sf_dir).select("job_id", "document", "metadata")))


# ---- history and prompts -------------------------------------------------------------------

RECENT = """SELECT user_id, role, message, turn, row_number() OVER (PARTITION BY user_id ORDER BY turn) AS seq FROM (
  SELECT conv_id::VARCHAR AS user_id, role, text AS message, turn,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations) WHERE back <= 6"""


def _recent(spark, sf_dir):
    talk = table(spark, sf_dir, "conversations")
    history = talk.select(F.col("conv_id").cast("string").alias("user_id"), "role", F.col("text").alias("message"), "turn")
    return retrieval.recent_messages(history, 6, "turn")


@query("recent_turns", RECENT)
def recent_turns(spark, sf_dir):
    return _recent(spark, sf_dir).withColumn("seq", F.col("seq").cast("bigint"))


NUMBERED = f"SELECT f.query_id, f.position, r.* FROM ({RETRIEVE}) f JOIN ({RESULT_SQL}) r ON r.job_id = f.job_id"
BLOCK = """concat('[', position, '] ', title, '\nCompany: ', company, '\nSource: \nLocation: ', locations,
  '\nCategory: \nExperience:  / \nWork:  / \nSalary: ', salary, ' ()\nPosted: \nURL: ', url, '\nContent: ', document)""".replace(
    "'\\n", "E'\\n"
)
CONTEXT = f"SELECT query_id, string_agg({BLOCK}, chr(10) || chr(10) ORDER BY position) AS context FROM ({NUMBERED}) GROUP BY query_id"


@query("prompt_context", CONTEXT)
def prompt_context(spark, sf_dir):
    return retrieval.build_context(_results(spark, sf_dir))


PROMPT = f"""SELECT r.query_id, r.user_id, concat('{retrieval.INSTRUCTIONS}', E'\n\nConversation history:\n',
    coalesce(h.history, 'No prior messages.'), E'\n\nRetrieved job context:\n', coalesce(c.context, 'No retrieved jobs.'),
    E'\n\nUser question:\n', r.message, E'\n\nAnswer:') AS prompt
  FROM (SELECT conv_id || '-' || turn AS query_id, conv_id::VARCHAR AS user_id, {MESSAGE} AS message FROM conversations) r LEFT JOIN ({CONTEXT}) c ON c.query_id = r.query_id
  LEFT JOIN (SELECT user_id, string_agg(role || ': ' || message, chr(10) ORDER BY seq) AS history FROM ({RECENT}) GROUP BY 1) h
    ON h.user_id = r.user_id"""


@query("prompt_full", PROMPT)
def prompt_full(spark, sf_dir):
    """End to end: plan, search or scan, records, context, history, prompt."""
    asks = _requests(spark, sf_dir).select("query_id", "user_id", "message")
    return retrieval.build_prompts(asks, _results(spark, sf_dir), _recent(spark, sf_dir))


@query("retrieve_prompts", PROMPT.replace("document)", "document[1:1200])"))
def retrieve_prompts(spark, sf_dir):
    """The same with documents cut to the length that fits a small model's context."""
    asks = _requests(spark, sf_dir).select("query_id", "user_id", "message")
    chars = fv.CONTEXT_DOCUMENT_CHARS
    return retrieval.build_prompts(asks, _results(spark, sf_dir, chars), _recent(spark, sf_dir), document_chars=chars)


@query(
    "result_lines",
    f"""SELECT query_id, position, concat(position, '. **', title, '** - ', company, E'\nSalary: ', salary,
        E'\nLocation: ', locations, E'\nExperience: Not specified\nLink: ', url) AS line FROM ({NUMBERED})""",
)
def result_lines(spark, sf_dir):
    return retrieval.result_lines(_results(spark, sf_dir)).select("query_id", F.col("position").cast("bigint").alias("position"), "line")


# ---- audit ---------------------------------------------------------------------------------

TASK = """CASE event_type WHEN 'click' THEN 'scrape_board_a_jobs' WHEN 'purchase' THEN 'insert_board_b_staging'
  WHEN 'view' THEN 'dbt_run_silver' WHEN 'signup' THEN 'Gold_models_bash' ELSE 'post_alerts' END"""
RUNS_SQL = f"""SELECT concat('run-', user_id::VARCHAR) AS dag_run_id,
    CASE WHEN user_id % 10 = 9 THEN 'other' ELSE 'jobs' END AS dag_id, ts AS execution_date, {TASK} AS task_id,
    CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS task_status, ts AS start_date,
    ts + to_milliseconds((value * 1000)::BIGINT) AS end_date, floor((value * 1000)::BIGINT / 1000)::INTEGER AS seconds,
    (event_id % 100)::INTEGER AS rows_processed FROM events"""


def _runs(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    task = F.expr(TASK)
    millis = F.round(F.col("value") * 1000).cast("bigint")
    start = F.col("ts")
    end = F.timestamp_micros(F.unix_micros(start.cast("timestamp")) + millis * 1000).cast("timestamp_ntz")
    none = F.lit(None).cast("string")
    return events.select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("dag_run_id"),
        F.when(F.col("user_id") % 10 == 9, "other").otherwise("jobs").alias("dag_id"),
        start.alias("execution_date"),
        none.alias("run_type"),
        task.alias("task_id"),
        F.lit("etl").alias("task_group"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("task_status"),
        start.cast("timestamp").alias("start_date"),
        end.cast("timestamp").alias("end_date"),
        F.lit(2).alias("try_number"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error_message"),
        F.lit("ValueError").alias("error_type"),
        none.alias("traceback"),
        (F.col("event_id") % 100).cast("int").alias("rows_processed"),
        F.lit(None).cast("int").alias("rows_inserted"),
        F.lit(None).cast("int").alias("rows_scraped"),
        F.when(F.col("event_type") == "click", F.split("props", "")).alias("scraped_rows"),
        F.lit(1).alias("posts_sent"),
        F.lit(0).alias("posts_failed"),
        F.when(F.col("event_type") == "error", F.create_map(F.lit("layer"), F.lit("alerts")))
        .otherwise(F.create_map().cast("map<string,string>"))
        .alias("overrides"),
    )


def _audit(spark, sf_dir):
    return audit.audit_records(_runs(spark, sf_dir), ("board_a", "board_b"))


SOURCE_SQL = """CASE task_id WHEN 'scrape_board_a_jobs' THEN 'board_a' WHEN 'insert_board_b_staging' THEN 'board_b'
  WHEN 'dbt_run_silver' THEN 'silver' WHEN 'Gold_models_bash' THEN 'gold' END"""
LAYER_SQL = """CASE task_id WHEN 'insert_board_b_staging' THEN 'staging' WHEN 'dbt_run_silver' THEN 'silver'
  WHEN 'Gold_models_bash' THEN 'gold' WHEN 'post_alerts' THEN 'alerts' END"""


@query(
    "audit_classify",
    f"""SELECT dag_run_id, execution_date, task_id, {SOURCE_SQL} AS data_source, {LAYER_SQL} AS layer, seconds AS duration_seconds,
        CASE WHEN task_id LIKE '%dbt%' OR task_id LIKE '%bash%' THEN 'bash' ELSE 'python' END AS task_type, 1 AS task_retry_count,
        rows_processed, CASE WHEN task_id = 'scrape_board_a_jobs' THEN length(props) ELSE 0 END AS rows_scraped,
        CASE WHEN task_status = 'failed' THEN props END AS error_message
        FROM (SELECT r.*, e.props FROM ({RUNS_SQL}) r POSITIONAL JOIN (SELECT props FROM events) e)""",
)
def audit_classify(spark, sf_dir):
    return _audit(spark, sf_dir).select(
        "dag_run_id", "execution_date", "task_id", "data_source", "layer", "duration_seconds", "task_type",
        "task_retry_count", "rows_processed", "rows_scraped", "error_message",
    )


@query(
    "audit_upsert",
    f"""SELECT dag_run_id, execution_date, task_id, CASE WHEN old AND task_status = 'failed' THEN 'failed'
          WHEN old THEN 'success' ELSE task_status END AS task_status, seconds AS duration_seconds,
        CASE WHEN old THEN 7 ELSE rows_processed END AS rows_processed FROM
        (SELECT *, rows_processed >= 50 AS old FROM ({RUNS_SQL}))""",
)
def audit_upsert(spark, sf_dir):
    """Runs that processed many rows are in the table; their records arrive again with other counts."""
    stamp = F.lit("2024-02-01").cast("timestamp")
    records = _audit(spark, sf_dir)
    table_rows = records.filter("rows_processed >= 50").withColumn("created_at", stamp).withColumn("updated_at", stamp)
    many = F.col("rows_processed") >= 50
    arriving = records.withColumn("rows_processed", F.when(many, 7).otherwise(F.col("rows_processed")))
    merged = audit.audit_upsert(table_rows, arriving, stamp)
    return merged.select("dag_run_id", "execution_date", "task_id", "task_status", "duration_seconds", "rows_processed")


@query(
    "audit_daily",
    f"""SELECT task_id AS task_name, execution_date::DATE AS execution_day, task_status AS dag_status,
        count(DISTINCT dag_run_id) AS total_dag_runs, count(DISTINCT task_id) AS total_tasks,
        count(*) FILTER (WHERE task_status = 'success') AS successful_tasks,
        count(*) FILTER (WHERE task_status = 'failed') AS failed_tasks, sum(rows_processed)::BIGINT AS total_rows_processed,
        0::BIGINT AS total_rows_inserted, sum(CASE WHEN task_id = 'scrape_board_a_jobs' THEN n ELSE 0 END)::BIGINT AS total_rows_scraped,
        count(*) AS total_discord_posts_sent, 0::BIGINT AS total_discord_posts_failed,
        round(avg(seconds), 6) AS avg_dag_duration_seconds, min(start_date) AS first_start_time, max(end_date) AS last_end_time
        FROM (SELECT r.*, length(e.props) AS n FROM ({RUNS_SQL}) r POSITIONAL JOIN (SELECT props FROM events) e)
        WHERE dag_id = 'jobs' GROUP BY 1, 2, 3""",
)
def audit_daily(spark, sf_dir):
    rows = audit.job_elt_summary(_audit(spark, sf_dir), "jobs")
    return rows.withColumns(
        {
            "avg_dag_duration_seconds": F.round("avg_dag_duration_seconds", 6),
            "first_start_time": F.col("first_start_time").cast("timestamp_ntz"),
            "last_end_time": F.col("last_end_time").cast("timestamp_ntz"),
        }
    )


@query(
    "audit_task_performance",
    f"""SELECT task_id AS task_name, 'etl' AS task_group, {SOURCE_SQL} AS data_source, {LAYER_SQL} AS layer,
        count(*) AS execution_count, count(*) FILTER (WHERE task_status = 'success') AS success_count,
        count(*) FILTER (WHERE task_status = 'failed') AS failure_count,
        round(100.0 * count(*) FILTER (WHERE task_status = 'success') / count(*), 2) AS success_rate_pct,
        round(avg(seconds), 6) AS avg_duration_seconds, min(seconds) AS min_duration_seconds,
        max(seconds) AS max_duration_seconds, round(avg(rows_processed), 6) AS avg_rows_processed,
        max(execution_date) AS last_execution_date FROM ({RUNS_SQL}) WHERE dag_id = 'jobs' GROUP BY ALL""",
)
def audit_task_performance(spark, sf_dir):
    rows = audit.task_performance(_audit(spark, sf_dir), "jobs")
    return rows.withColumns(
        {c: F.round(c, 6) for c in ("avg_duration_seconds", "avg_rows_processed")}
    )
