"""Data checks: each check counts its failures and keeps a bounded sample of the values that failed."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from postlens import fixed_values as fv
from postlens.operators.keys import repeated_keys, top_per_key


@dataclass(frozen=True)
class Check:
    """`kind` is row_count, not_null, unique or matches."""

    kind: str
    column: str = ""
    pattern: str = ""
    low: int = 1
    high: int | None = None


class QualityError(ValueError):
    """Raised by `require` when a check failed."""


def batch_checks(url_pattern: str, *required: str, low: int = 1, high: int | None = None) -> list[Check]:
    """Checks of one crawled batch: its size, its urls and the columns it must fill."""
    return [
        Check("row_count", low=low, high=high),
        Check("not_null", "url"),
        Check("unique", "url"),
        *[Check("not_null", c) for c in required],
        Check("matches", "url", url_pattern),
    ]


BOARD_A_CHECKS = batch_checks("^https://", "descriptions", "requirements")
BOARD_B_CHECKS = batch_checks("^https?://", "descriptions", "requirements", "experience")


def required_gate(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Adds `missing`: the required fields a record leaves empty."""
    gaps = [F.when(F.coalesce(F.col(f), F.lit("")) == "", F.lit(f)) for f in fields]
    return df.withColumn("missing", F.array_compact(F.array(*gaps)))


def _row_failure(check: Check) -> Column:
    if check.kind == "not_null":
        return F.col(check.column).isNull()
    return ~F.col(check.column).rlike(check.pattern)  # NULL, hence no failure, for a NULL value


def _within(rows: Column, check: Check) -> Column:
    return rows >= check.low if check.high is None else rows.between(check.low, check.high)


def run_checks(df: DataFrame, checks: Sequence[Check], samples: int = fv.SAMPLE_VALUES) -> DataFrame:
    """One row per check: (check, column, failed, sample).

    All row-level checks share one scan and one aggregate; a uniqueness check groups by its key once, for its count
    and its sample. At most `samples` values per check are kept, cut in every map task before the shuffle.
    """
    results = []
    rows = [c for c in checks if c.kind in ("not_null", "matches")]
    sizes = [c for c in checks if c.kind == "row_count"]
    if rows or sizes:
        counts = [F.count_if(_row_failure(c)).alias(f"_{i}") for i, c in enumerate(rows)]
        totals = df.agg(F.count("*").alias("_rows"), *counts)
        cells = [
            F.struct(F.lit(c.kind).alias("check"), F.lit(c.column).alias("column"), F.col(f"_{i}").alias("failed"))
            for i, c in enumerate(rows)
        ] + [
            F.struct(
                F.lit(c.kind).alias("check"),
                F.lit(c.column).alias("column"),
                (~_within(F.col("_rows"), c)).cast("bigint").alias("failed"),
            )
            for c in sizes
        ]
        results.append(totals.select(F.inline(F.array(*cells))))
    none = F.array().cast("array<string>")
    sampled = _samples(df, [c for c in checks if c.kind == "matches"], samples)
    counted = reduce(DataFrame.unionByName, results) if results else None
    if counted is not None and sampled is not None:
        counted = counted.join(sampled, ["check", "column"], "left").withColumn("sample", F.coalesce("sample", none))
    elif counted is not None:
        counted = counted.withColumn("sample", none)
    unique = [_repeated(df, c.column, samples) for c in checks if c.kind == "unique"]
    return reduce(DataFrame.unionByName, [*([counted] if counted is not None else []), *unique])


def _repeated(df: DataFrame, column: str, samples: int) -> DataFrame:
    """A uniqueness check: the rows with a repeated key and the first such keys, both from one exchange of the keys."""
    repeated = repeated_keys(df, [column]).select(F.col(column).cast("string").alias("value"), "rows")
    first = repeated.orderBy("value").limit(samples).select(F.lit(0).cast("bigint").alias("rows"), "value")
    both = repeated.agg(F.sum("rows").alias("rows")).select("rows", F.lit(None).cast("string").alias("value")).union(first)
    return both.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("failed"), F.sort_array(F.collect_list("value")).alias("sample")
    ).select(F.lit("unique").alias("check"), F.lit(column).alias("column"), "failed", "sample")


def _samples(df: DataFrame, matches: Sequence[Check], samples: int) -> DataFrame | None:
    if not matches:
        return None
    hits = [
        F.when(
            _row_failure(c),
            F.struct(F.lit(c.kind).alias("check"), F.lit(c.column).alias("column"), F.col(c.column).alias("value")),
        )
        for c in matches
    ]
    failing = df.select(F.inline(F.array_compact(F.array(*hits))))
    few = top_per_key(failing, ["check", "column"], [F.col("value").asc()], samples)
    return few.groupBy("check", "column").agg(F.sort_array(F.collect_list("value")).alias("sample"))


def require(df: DataFrame, checks: Sequence[Check], name: str) -> DataFrame:
    """Return `df` unchanged when it has rows and passes; raise with every failed check otherwise.

    The result has one row per check, so reading it on the driver is bounded by the list of checks.
    """
    if df.isEmpty():
        raise QualityError(f"{name}: no records to validate")
    failed = run_checks(df, checks).filter("failed > 0").orderBy("check", "column").collect()
    if failed:
        listed = "; ".join(f"{r['check']} {r['column']} ({r['failed']} rows, e.g. {list(r['sample'])})" for r in failed)
        raise QualityError(f"{name}: {listed}")
    return df


@dataclass(frozen=True)
class Measured:
    """Checks that are counted while a table is written (`observed` is what to write)."""

    observed: DataFrame
    checks: Sequence[Check]
    name: str
    metrics: Observation

    def require(self, written: DataFrame) -> DataFrame:
        """Return the written table when it passes; raise as the function `require` does otherwise.

        Row counts, NULLs and patterns were counted by the write itself. A unique column is grouped by the hash of its
        values in a pass of its own; only if hashes repeat are the values looked at, and samples only when something failed.
        """
        seen = self.metrics.get
        unique = [c.column for c in self.checks if c.kind == "unique"]
        failed = not seen["rows"] or any(seen[f"check_{i}"] for i, c in enumerate(self.checks) if c.kind in ("not_null", "matches"))
        failed = failed or any(c.kind == "row_count" and not _holds(seen["rows"], c) for c in self.checks)
        failed = failed or any(not repeated_keys(_hashes(written, column), [column]).isEmpty() for column in unique)
        return require(written, self.checks, self.name) if failed else written


def _hashes(df: DataFrame, column: str) -> DataFrame:
    """Hashes of a column's values, NULL for NULL, which no repeated value can hide among."""
    return df.select(F.when(F.col(column).isNotNull(), F.xxhash64(column)).alias(column))


def _holds(rows: int, check: Check) -> bool:
    return rows >= check.low and (check.high is None or rows <= check.high)


def measured(df: DataFrame, checks: Sequence[Check], name: str) -> Measured:
    """`df` with its checks counted by whatever writes it, in the same job."""
    metrics = Observation(f"{name}-{uuid.uuid4().hex}")
    counts = [F.count_if(_row_failure(c)).alias(f"check_{i}") for i, c in enumerate(checks) if c.kind in ("not_null", "matches")]
    return Measured(df.observe(metrics, F.count(F.lit(1)).alias("rows"), *counts), checks, name, metrics)


def _not_null(*columns: str) -> list[Check]:
    return [Check("not_null", c) for c in columns]


def _keyed(key: str, *columns: str) -> list[Check]:
    return [Check("not_null", key), Check("unique", key), *_not_null(*columns)]


MODEL_CHECKS: dict[str, list[Check]] = {
    "stg_board_a_jobs": _keyed("url", "company", "requirements_and_experiences", "created_at"),
    "stg_board_b_jobs": _keyed("url", "company", "descriptions", "requirements", "experiences", "created_at"),
    "int_board_a_jobs": _not_null("source_platform", "url"),
    "int_board_b_jobs": _not_null("source_platform", "url"),
    "int_jobs_unified": _not_null("job_id", "source_platform", "url", "job_posted_date"),
    "fct_jobs": _not_null("job_id", "url", "source_platform", "company_id", "job_posted_date"),
    "dim_company": _keyed("company_id", "company_name"),
    "dim_location": _not_null("location_id", "job_location"),
    "dim_education": _not_null("education_id"),
    "dim_work_model": _not_null("work_model_id"),
    "dim_salary_band": _not_null("salary_band_id"),
    "dim_job_category": _not_null("job_category_id"),
    "rpt_company_hiring_summary": _keyed("company_id", "company_name", "total_job_postings"),
    "rpt_education_distribution": _keyed("education_id", "education_requirement", "job_count"),
    "rpt_job_category_analysis": _keyed("job_category_id", "job_category", "num_positions"),
    "rpt_job_market_daily": _not_null("job_posted_date", "source_platform", "daily_job_postings"),
    "rpt_location_salary_analysis": _keyed("location_id", "job_location", "total_jobs"),
    "rpt_platform_comparison": _keyed("source_platform", "total_job_postings"),
    "rpt_salary_benchmark": _keyed("salary_band_id", "salary_band", "num_positions"),
    "rpt_work_model_analysis": _keyed("work_model_id", "work_model_normalized", "job_count"),
    "job_elt_summary": _not_null("task_name", "execution_day"),
    "task_performance": _not_null("task_name", "execution_count"),
    "vector_db": _keyed("job_id", "url", "embedding_text"),
}
