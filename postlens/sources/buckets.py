"""Tables laid out by the hash of their key, so that a change rewrites the buckets it touches and no others.

A bucket is a partition folder of plain Parquet; Spark's dynamic partition overwrite replaces the touched ones when the
job commits and deletes their old files. Which buckets a batch touches follows from its keys alone, so only those are
scanned. What is to be written is written to the shared folder first: the overwrite then reads nothing that it
replaces, and a batch that failed half way can be merged again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.session import materialise

BUCKET = "_bucket"


@dataclass(frozen=True)
class BucketedTable:
    """A table below `path` with the rows of `schema`; `keys` decide a row's bucket. Keys and number stay as created."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: Sequence[str]
    buckets: int = 64

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _with_bucket(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]).withColumn(BUCKET, self._bucket())

    def _scan(self) -> DataFrame:
        """All rows with their bucket; a table that was never written is empty."""
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _store(self, rows: DataFrame) -> None:
        """Replace the buckets that `rows` (with their bucket) hold; a bucket is written by one task."""
        dealt = rows.repartition(min(self.buckets, self._tasks()), BUCKET)
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)

    def _tasks(self) -> int:
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _drop(self, buckets: Sequence[int]) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for bucket in buckets:
            folder = path(f"{self.path}/{BUCKET}={bucket}")
            folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

    def read(self) -> DataFrame:
        return self._scan().drop(BUCKET)

    def create(self, rows: DataFrame) -> None:
        """The table with these rows and no others."""
        self._with_bucket(rows).repartition(self._tasks(), BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(self.path)

    def touched(self, changes: DataFrame) -> list[int]:
        """Buckets of the keys of some changes, at most as many as the table has."""
        return sorted(r[0] for r in changes.select(self._bucket().alias(BUCKET)).distinct().collect())

    def merge(self, changes: DataFrame, step: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Replace the touched buckets by `step(their rows, changes)`; returns them.

        `step` sees all rows that share a bucket with a change, so any step by key is right (upsert, merge, delete). It
        must give the same when its result is merged with the same changes again, which makes a repeated batch harmless.
        """
        changes = materialise(changes, "bucket-changes")
        touched = self.touched(changes)
        if touched:
            part = self._scan().filter(F.col(BUCKET).isin(touched)).drop(BUCKET)
            rows = materialise(self._with_bucket(step(part, changes)), "bucket-rows")
            left = {r[0] for r in rows.select(BUCKET).distinct().collect()}
            if not left <= set(touched):
                raise ValueError("a step made rows whose keys were not among the changes' buckets")
            self._store(rows)
            self._drop([b for b in touched if b not in left])
        return touched

    def append(self, rows: DataFrame) -> None:
        """Add rows; nothing that is stored is read or written again."""
        dealt = self._with_bucket(rows).repartition(min(self.buckets, self._tasks()), BUCKET)
        dealt.write.mode("append").partitionBy(BUCKET).parquet(self.path)
