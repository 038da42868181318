"""Record schemas, and the mapping from crawl fields to staging columns."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _staging(*names: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField("id", T.LongType()),
            *_strings(*names),
            T.StructField("posted_to_discord", T.BooleanType()),
            T.StructField("created_at", T.TimestampType()),
        ]
    )


# Board A lists tags and a work model; board B lists a salary, an education level and a kind of contract.
CRAWL_A = T.StructType(
    _strings("title", "company", "logo", "url", "job_cat", "location", "mode", "tags", "descriptions", "requirements")
)
CRAWL_B = T.StructType(
    _strings(
        "title", "company", "logo", "url", "location", "salary", "descriptions", "requirements",
        "experience", "education", "type_of_work", "job_cat",
    )
)
STAGING_A = _staging(
    "title", "company", "logo_url", "url", "job_category", "working_location",
    "work_model", "tags", "descriptions", "requirements_and_experiences",
)
STAGING_B = _staging(
    "title", "company", "logo_url", "url", "job_category", "working_location", "salary",
    "descriptions", "requirements", "experiences", "level_of_education", "work_model",
)
LOGOS = T.StructType(
    [
        *_strings("logo_id", "logo_url", "logo_path"),
        T.StructField("is_downloaded", T.BooleanType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)
CHAT = T.StructType([*_strings("user_id", "role", "message"), T.StructField("timestamp", T.TimestampType())])

# crawl field -> staging column, where the names differ
_COMMON = {"logo": "logo_url", "job_cat": "job_category", "location": "working_location"}
RENAME_A = {**_COMMON, "mode": "work_model", "requirements": "requirements_and_experiences"}
RENAME_B = {**_COMMON, "experience": "experiences", "education": "level_of_education", "type_of_work": "work_model"}

AUDIT_MUTABLE = (
    "task_status", "task_end_date", "task_duration_seconds", "task_retry_count",
    "rows_processed", "rows_inserted", "rows_updated", "rows_scraped", "rows_posted_discord",
    "dbt_models_run", "dbt_models_success", "dbt_models_failed",
    "error_message", "error_type", "exception_traceback", "discord_posts_sent", "discord_posts_failed",
)
AUDIT_KEYS = ("dag_run_id", "task_id", "execution_date")
