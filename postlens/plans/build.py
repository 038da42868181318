"""The whole build in order: crawl records, staging, bronze, silver, gold, reports, text to embed, embeddings, audit.

Every model is written and checked before anything reads it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from postlens import fixed_values as fv
from postlens.operators.keys import dedupe_first
from postlens.operators.merge import upsert_latest
from postlens.operators.quality import MODEL_CHECKS, Check, QualityError, measured, require, required_gate
from postlens.operators.vectors import embed_text
from postlens.plans import audit, gold, reports, silver
from postlens.plans.bronze import merge_bronze, stg_board_a_jobs, stg_board_b_jobs
from postlens.plans.embedding import rows_to_embed, vector_db

MODELS_AT_ONCE = 4  # of those that do not read each other

DIMENSIONS = {
    "dim_company": gold.dim_company,
    "dim_education": gold.dim_education,
    "dim_job_category": gold.dim_job_category,
    "dim_location": gold.dim_location,
    "dim_salary_band": gold.dim_salary_band,
    "dim_work_model": gold.dim_work_model,
}
DIMENSION_REPORTS = {
    "rpt_company_hiring_summary": (reports.rpt_company_hiring_summary, "dim_company"),
    "rpt_education_distribution": (reports.rpt_education_distribution, "dim_education"),
    "rpt_job_category_analysis": (reports.rpt_job_category_analysis, "dim_job_category"),
    "rpt_location_salary_analysis": (reports.rpt_location_salary_analysis, "dim_location"),
    "rpt_salary_benchmark": (reports.rpt_salary_benchmark, "dim_salary_band"),
    "rpt_work_model_analysis": (reports.rpt_work_model_analysis, "dim_work_model"),
}
FACT_REPORTS = {
    "rpt_job_market_daily": reports.rpt_job_market_daily,
    "rpt_platform_comparison": reports.rpt_platform_comparison,
}


@dataclass(frozen=True)
class Store:
    """Tables as parquet folders, one per run, so that a run never overwrites what it reads."""

    spark: SparkSession
    base: str
    run: str
    previous: str | None = None

    def path(self, layer: str, name: str, run: str) -> str:
        return f"{self.base.rstrip('/')}/{layer}/{name}/run={run}"

    def write(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        path = self.path(layer, name, self.run)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def append(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        """Add the rows of this run to a table that only grows; returns the whole table. What earlier runs wrote stays.

        A run that is repeated replaces its own rows.
        """
        df.write.mode("overwrite").parquet(self.path(layer, name, self.run))
        return self._runs(layer, name, df.schema).drop("run")

    def grown(self, layer: str, name: str) -> DataFrame | None:
        """A table that only grows, without the rows of this run."""
        if not self.previous:
            return None
        schema = self.spark.read.parquet(self.path(layer, name, self.previous)).schema
        return self._runs(layer, name, schema).filter(F.col("run") != self.run).drop("run")

    def _runs(self, layer: str, name: str, schema: T.StructType) -> DataFrame:
        runs = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
        return self.spark.read.schema(runs).parquet(f"{self.base.rstrip('/')}/{layer}/{name}")

    def before(self, layer: str, name: str) -> DataFrame | None:
        """The table as the previous run left it."""
        return self.spark.read.parquet(self.path(layer, name, self.previous)) if self.previous else None


@dataclass(frozen=True)
class Crawl:
    """One board's crawled records and what they have to satisfy before they are staged.

    `renames` maps record fields to staging columns; `required` fields must be filled, or the record is left out.
    """

    records: DataFrame
    renames: dict[str, str]
    required: Sequence[str]
    checks: Sequence[Check]
    order: str


def stage_crawl(staging: DataFrame, crawl: Crawl, name: str, on_insert: dict[str, Column] | None = None) -> DataFrame:
    """Next state of a staging table: first record of each url, complete and checked, upserted by url.

    Records that lack a required field are left out; a batch that fails a check raises.
    """
    first = dedupe_first(crawl.records, "url", crawl.order)
    complete = required_gate(first, crawl.required).filter(F.size("missing") == 0).drop("missing")
    checked = require(complete, crawl.checks, name)
    renamed = checked.select(*[F.col(field).alias(column) for field, column in crawl.renames.items()], F.col(crawl.order).alias("_order"))
    mutable = [c for c in crawl.renames.values() if c != "url"]
    return upsert_latest(staging, renamed, "url", "_order", mutable, on_insert)


def stage_boards(boards: dict[str, tuple[DataFrame, Crawl]], on_insert: dict[str, Column] | None = None) -> dict[str, DataFrame]:
    """Staging tables of all boards by name; a board whose batch fails keeps its table, unless all of them fail."""
    staged, failures = {}, []
    for name, (staging, crawl) in boards.items():
        try:
            staged[name] = stage_crawl(staging, crawl, name, on_insert)
        except QualityError as error:
            failures.append(str(error))
            staged[name] = staging
    if len(failures) == len(boards):
        raise QualityError("; ".join(failures))
    return staged


def build_all(
    store: Store,
    staging_a: DataFrame,
    staging_b: DataFrame,
    logos: DataFrame,
    load_time: Column | None = None,
    runs: DataFrame | None = None,
    dag: str = "",
    embedder=None,
    mappings: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Build and check every model; returns the written tables by name.

    `mappings` are the seed tables of categories and cities (`tables.read_mappings`); each one given takes the place of
    the built-in list.

    With an `embedder` the texts that the collection does not hold yet are embedded and appended to it. `runs` are the
    audit records; their summaries of workflow `dag` come last.
    """
    built: dict[str, DataFrame] = {}

    def add(layer: str, name: str, df: DataFrame) -> DataFrame:
        counted = measured(df, MODEL_CHECKS.get(name, ()), name)
        written = store.write(layer, name, counted.observed)
        built[name] = counted.require(written) if name in MODEL_CHECKS else written
        return written

    def extend(layer: str, name: str, fresh: DataFrame) -> DataFrame:
        whole = store.append(layer, name, fresh)
        built[name] = require(whole, MODEL_CHECKS[name], name) if name in MODEL_CHECKS else whole
        return whole

    def together(layer: str, models: dict[str, Callable[[], DataFrame]]) -> None:
        """Models that do not read each other, side by side: cores that the last tasks of one leave free work on the next.

        All are awaited; of several that fail the first one's error is raised.
        """
        with ThreadPoolExecutor(MODELS_AT_ONCE) as pool:
            run = inheritable_thread_target(store.spark)(lambda name, model: add(layer, name, model()))
            steps = [pool.submit(run, name, model) for name, model in models.items()]
        for step in steps:
            step.result()

    bronze = {"stg_board_a_jobs": (stg_board_a_jobs, staging_a), "stg_board_b_jobs": (stg_board_b_jobs, staging_b)}
    merged = lambda name, model, staging: merge_bronze(model, staging, store.before("bronze", name))
    together("bronze", {name: partial(merged, name, *of) for name, of in bronze.items()})
    mappings = mappings or {}
    categories = mappings.get("job_category_mapping", fv.CATEGORY_PATTERNS)
    cities = mappings.get("vn_city_mapping", fv.CITY_PATTERNS)
    together(
        "silver",
        {
            "int_board_a_jobs": lambda: silver.int_board_a_jobs(built["stg_board_a_jobs"], patterns=categories),
            "int_board_b_jobs": lambda: silver.int_board_b_jobs(built["stg_board_b_jobs"], patterns=categories),
        },
    )
    a, b = built["int_board_a_jobs"], built["int_board_b_jobs"]
    jobs = add("silver", "int_jobs_unified", silver.int_jobs_unified(a, b, logos, cities, load_time))
    dimensions = {name: partial(model, jobs, load_time) for name, model in DIMENSIONS.items()}
    together("gold", {"fct_jobs": lambda: gold.fct_jobs(jobs), **dimensions, "dim_company_logo": lambda: gold.dim_company_logo(logos)})
    fact = built["fct_jobs"]
    by_dimension = {name: partial(report, built[dimension], fact) for name, (report, dimension) in DIMENSION_REPORTS.items()}
    together("reports", {**by_dimension, **{name: partial(report, fact) for name, report in FACT_REPORTS.items()}})
    texts = extend("vector_db", "vector_db", vector_db(fact, jobs, store.grown("vector_db", "vector_db"), by_key=False))
    if embedder is not None:
        held = store.grown("collection", "embeddings")
        rows = texts.select("job_id", "embedding_text")
        new = rows if held is None else rows_to_embed(rows, held, F.col("job_id"))
        extend("collection", "embeddings", embed_text(new, "embedding_text", embedder).select("job_id", "embedding"))
    if runs is not None:
        add("audit", "job_elt_summary", audit.job_elt_summary(runs, dag))
        add("audit", "task_performance", audit.task_performance(runs, dag))
    return built
