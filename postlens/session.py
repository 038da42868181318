"""Session settings and the shared folder used for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Settings a deployment should start from; sizes that depend on the cluster stay with spark-submit.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session with the defaults above; `conf` entries win."""
    builder = SparkSession.builder.appName("postlens")
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, or a fresh one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="postlens-"))
    return context.getCheckpointDir().rstrip("/")


_written: list[tuple[int, str]] = []  # (thread, path)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has written to yet."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append((threading.get_ident(), path))
    return path


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> int:
    """Delete the intermediate tables written so far, once the results that read them are stored; returns their number."""
    paths = [path for _, path in _written]
    _written.clear()
    for path in paths:
        _delete(spark, path)
    return len(paths)


def materialise(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write once to the shared folder and read back, so later steps do not recompute the plan.

    A written table survives the loss of executors, and column pruning and filters reach its scan.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_by_key(df: DataFrame, name: str, key: str) -> DataFrame:
    """`materialise`, laid out by the hash of a column in as many buckets as there are shuffle partitions.

    Grouping the result by the column needs no shuffle, and compressed columns take a fraction of the room that shuffled
    rows take. Rows are dealt by the tasks that make them: one file for each task and bucket.
    """
    spark, path, table = df.sparkSession, fresh_path(df.sparkSession, name), f"postlens_{uuid.uuid4().hex}"
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    writer = df.write.format("parquet").option("compression", "zstd").option("path", path)
    writer.bucketBy(buckets, key).saveAsTable(table)
    written = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the files stay until `release`
    return written


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for table in tables:
        folders = {file.rsplit("/", 2)[-2] for file in table.inputFiles()}
        for entry in [entry for entry in _written if entry[1].rsplit("/", 1)[-1] in folders]:
            _written.remove(entry)
            _delete(table.sparkSession, entry[1])


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now: it does so when the driver collects their plans."""
    spark.sparkContext._jvm.System.gc()


def settled(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What `build` returns, written small; the tables and shuffle files that it needed on its way are deleted.

    For large tables that are made of other large tables: only the result stays on disk. `build` must not hand out frames
    that read its own tables in any other way.
    """
    mine, mark = threading.get_ident(), len(_written)
    result = materialise(build(), name, "zstd")
    for entry in [entry for entry in _written[mark:] if entry[0] == mine][:-1]:
        _written.remove(entry)
        _delete(spark, entry[1])
    free_shuffles(spark)
    return result
