"""Throttles as batch jobs and as streams, and the streaming upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlens.catalog.operators import DELTA, _delta, _target
from postlens.catalog.registry import query, table
from postlens.operators import merge, throttle
from postlens.session import fresh_path
from postlens.sources.buckets import BucketedTable
from postlens.streaming.ingest import ingest_stream
from postlens.streaming.throttle import throttle_stream

# Three requests per hour, so that the sparse events run into the limit.
LIMIT = {"limit": 3, "seconds": 3600}


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts")


def _plain(decided):
    return decided.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# A chain of windows per user: the next one opens at the first event an hour or more after the last opening.
FIXED = """
WITH RECURSIVE e AS (SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
w AS (SELECT user_id, event_id, ts, n, ts AS opened, 1 AS k FROM e WHERE n = 1
  UNION ALL SELECT e.user_id, e.event_id, e.ts, e.n,
    CASE WHEN e.ts >= w.opened + INTERVAL 3600 SECOND THEN e.ts ELSE w.opened END,
    CASE WHEN e.ts >= w.opened + INTERVAL 3600 SECOND THEN 1 ELSE w.k + 1 END
  FROM w JOIN e ON e.user_id = w.user_id AND e.n = w.n + 1)
SELECT user_id, event_id, ts, k <= 3 AS allowed, CASE WHEN k <= 3 THEN 3 - k ELSE 0 END::INTEGER AS remaining,
  CASE WHEN k <= 3 THEN 0 ELSE coalesce(nullif(floor((epoch_us(opened) + 3600000000 - epoch_us(ts)) / 1000000.0 + 0.5), 0), 3600) END::INTEGER
    AS retry_after FROM w"""

SLIDING = """
WITH RECURSIVE e AS (SELECT user_id, event_id, ts, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
  FROM events),
w AS (SELECT user_id, event_id, ts, n, [t] AS log, true AS allowed, 2 AS remaining, 0 AS retry_after FROM e WHERE n = 1
  UNION ALL SELECT user_id, event_id, ts, n, CASE WHEN len(live) < 3 THEN list_append(live, t) ELSE live END, len(live) < 3,
    CASE WHEN len(live) < 3 THEN 2 - len(live) ELSE 0 END::INTEGER,
    CASE WHEN len(live) < 3 THEN 0 ELSE greatest(1, trunc((3600000000 - (t - live[1])) / 1000000.0)) END::INTEGER
  FROM (SELECT e.*, [x FOR x IN w.log IF x > e.t - 3600000000] AS live FROM w JOIN e ON e.user_id = w.user_id AND e.n = w.n + 1))
SELECT user_id, event_id, ts, allowed, remaining::INTEGER AS remaining, retry_after::INTEGER AS retry_after FROM w"""


@query("throttle_fixed", FIXED)
def throttle_fixed(spark, sf_dir):
    return _plain(throttle.throttle_fixed(_events(spark, sf_dir), chunk_seconds=86_400, **LIMIT))


@query("throttle_sliding", SLIDING)
def throttle_sliding(spark, sf_dir):
    return _plain(throttle.throttle_sliding(_events(spark, sf_dir), **LIMIT))


def _streamed(spark, sf_dir, kind):
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet")
    out = fresh_path(spark, f"throttle-{kind}")
    decided = throttle_stream(events.select("event_id", "user_id", "ts"), kind, **LIMIT)
    query_ = (
        decided.writeStream.format("parquet")
        .option("checkpointLocation", fresh_path(spark, "stream"))
        .trigger(availableNow=True)
        .start(out)
    )
    query_.awaitTermination()
    return _plain(spark.read.schema(decided.schema).parquet(out))


@query("throttle_fixed_stream", FIXED)
def throttle_fixed_stream(spark, sf_dir):
    return _streamed(spark, sf_dir, "fixed")


@query("throttle_sliding_stream", SLIDING)
def throttle_sliding_stream(spark, sf_dir):
    return _streamed(spark, sf_dir, "sliding")


@query(
    "stream_upsert",
    f"""SELECT o_orderkey, coalesce(d.o_totalprice, t.o_totalprice) AS o_totalprice,
        CASE WHEN t.o_orderkey IS NULL THEN 'new' ELSE t.o_orderstatus END AS o_orderstatus
        FROM (SELECT * FROM orders WHERE o_orderstatus <> 'P') t FULL JOIN ({DELTA}) d USING (o_orderkey)""",
)
def stream_upsert(spark, sf_dir):
    """Changed orders land as JSON files and are upserted into a bucketed table, one micro-batch per file."""
    landing = fresh_path(spark, "landing")
    columns = ["o_orderkey", "o_totalprice", "o_orderstatus"]
    target = _target(spark, sf_dir).select(*columns)
    orders = BucketedTable(spark, fresh_path(spark, "orders"), target.schema, ["o_orderkey"], 16)
    orders.create(target)
    _delta(spark, sf_dir).select(*columns).repartition(2, "o_orderkey").write.json(landing)
    ingest_stream(spark, landing, target.schema, orders, fresh_path(spark, "stream"), _upsert_price, files_per_batch=1)
    return orders.read()


def _upsert_price(state, batch):
    batch = batch.withColumn("seq", F.lit(1))
    return merge.upsert_latest(state, batch, "o_orderkey", "seq", ["o_totalprice"], {"o_orderstatus": F.lit("new")})


@query(
    "bucketed_merge",
    f"""SELECT o_orderkey, coalesce(d.o_totalprice, t.o_totalprice) AS o_totalprice,
        CASE WHEN t.o_orderkey IS NULL THEN 'new' ELSE t.o_orderstatus END AS o_orderstatus
        FROM (SELECT * FROM orders WHERE o_orderstatus <> 'P') t FULL JOIN ({DELTA}) d USING (o_orderkey)
        UNION ALL SELECT -o_orderkey, o_totalprice, 'appended' FROM orders WHERE o_orderstatus = 'P'""",
)
def bucketed_merge(spark, sf_dir):
    """The same change twice, which changes nothing more, and new rows appended; only touched buckets are written."""
    columns = ["o_orderkey", "o_totalprice", "o_orderstatus"]
    target = _target(spark, sf_dir).select(*columns)
    orders = BucketedTable(spark, fresh_path(spark, "orders"), target.schema, ["o_orderkey"], 16)
    orders.create(target)
    for _ in range(2):
        orders.merge(_delta(spark, sf_dir).select(*columns), _upsert_price)
    more = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    orders.append(more.select((-F.col("o_orderkey")).alias("o_orderkey"), "o_totalprice", F.lit("appended").alias("o_orderstatus")))
    return orders.read()
