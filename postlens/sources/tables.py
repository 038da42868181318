"""Landing files, seed files, source lists and layered tables."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def landing_path(base: str, source: str, run: dt.datetime) -> str:
    return f"{base.rstrip('/')}/{source}/{source}_{run:%Y%m%d%H%M%S}_jobs.json"


def write_landing(records: DataFrame, base: str, source: str, run: dt.datetime) -> str | None:
    """Write a crawl as JSON under its source and run time; an empty crawl writes nothing."""
    if records.isEmpty():
        return None
    path = landing_path(base, source, run)
    records.write.mode("errorifexists").option("ignoreNullFields", False).json(path)
    return path


def read_landing(spark: SparkSession, path: str | None, schema: T.StructType, array_files: bool = False) -> DataFrame:
    """Read a landed crawl; `array_files` reads files that hold one JSON array. A missing path is empty."""
    if path:
        try:
            return spark.read.schema(schema).option("multiLine", array_files).json(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], schema)


def read_rescued(spark: SparkSession, path: str | None, schema: T.StructType, rescue: str = "_rescued") -> DataFrame:
    """Read landed JSON lines whose fields drift: the columns of `schema` and one with all that they could not take.

    A value that can be read as its column's type fills it, else the column is NULL. Fields that the schema does not know
    and values of another kind are kept in `rescue`, a VARIANT object by field name; it is NULL where nothing is left
    over. A line that is no JSON object is kept whole, as `_line`. A missing path is empty.
    """
    try:
        lines = spark.read.text(path) if path else None
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = None
    if lines is None:
        return spark.createDataFrame([], schema).withColumn(rescue, F.lit(None).cast("variant"))
    parsed = lines.select(F.col("value").alias("_line"), F.from_json("value", "map<string,variant>").alias("_fields"))
    given = lambda f: F.col("_fields")[f.name]
    typed = [F.try_variant_get(given(f), "$", f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    typed = parsed.select("_line", "_fields", F.struct(*typed).alias("_typed"))
    lost = [F.when(given(f).isNotNull() & ~F.is_variant_null(given(f)) & F.col("_typed")[f.name].isNull(), F.lit(f.name)) for f in schema.fields]
    names = [f.name for f in schema.fields]
    left = F.map_filter("_fields", lambda k, v: ~k.isin(names) | F.array_contains(F.array_compact(F.array(*lost)), k))
    kept = F.when(F.col("_fields").isNull(), F.to_variant_object(F.create_map(F.lit("_line"), F.col("_line"))))
    kept = kept.when(F.size(left) > 0, F.to_variant_object(left))
    return typed.select("_typed.*", kept.alias(rescue))


def read_table(spark: SparkSession, name: str, jdbc: dict | None = None) -> DataFrame:
    """A catalog table, or with `jdbc` options (url, partitionColumn, bounds, numPartitions) a relational one."""
    if jdbc:
        return spark.read.format("jdbc").options(dbtable=name, **jdbc).load()
    return spark.read.table(name)


def spread_small(df: DataFrame, *columns: str) -> DataFrame:
    """Spread a scan that has fewer partitions than the cluster has cores; a large scan stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *columns) if df.rdd.getNumPartitions() < cores else df


#: The two mapping seeds, their file names and columns.
SEEDS = {
    "job_category_mapping": "pattern string, target_job_category string",
    "vn_city_mapping": "pattern string, city_code string, city_en string, region string",
}


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A seed file with a header; a quote inside a quoted value is doubled, a backslash is a plain character."""
    return spark.read.option("header", True).option("escape", '"').schema(schema).csv(path)


def read_mappings(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Both mapping seeds of a folder, by name."""
    return {name: read_seed(spark, f"{folder.rstrip('/')}/{name}.csv", schema) for name, schema in SEEDS.items()}


def source_list(lists: DataFrame, source: str, known: tuple[str, ...]) -> DataFrame:
    """(name, url) rows of one source's JSON list, from rows (source, content); invalid content gives no rows."""
    if source not in known:
        raise ValueError(f"unknown source {source!r}, expected one of {known}")
    parsed = F.from_json("content", "map<string,string>")
    return lists.filter(F.col("source") == source).select(F.explode(parsed).alias("name", "url"))


def layer_of(custom: str | None, default: str) -> str:
    """A layer named for a model is used as it is, else the default."""
    return custom.strip() if custom else default


def write_layer(df: DataFrame, table: str, layer: str | None = None, default: str = "default", **write) -> DataFrame:
    """Full refresh of `layer.table`; options such as `partitionBy` go to the writer. Returns the written table."""
    spark = df.sparkSession
    database = layer_of(layer, default)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    name = f"`{database}`.`{table}`"
    df.write.mode("overwrite").saveAsTable(name, **write)
    return spark.read.table(name)


def rename_crawl(records: DataFrame, names: dict[str, str]) -> DataFrame:
    """Crawl fields under their staging column names."""
    return records.withColumnsRenamed(names)
