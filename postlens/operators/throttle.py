"""Request throttles per key, decided in event-time order.

Both decide one event after the other, so a key cannot simply be cut anywhere. Exact cuts are used:

* A pause of a whole window empties the state. And where two neighbouring window-sized cells of a key hold at most
  `limit` events together, all events of the later one were accepted whatever came before, and they are the whole
  state for the next cell. Keys are split into segments at both, found on the counts of (key, cell) pairs, never on
  the events; a segment after a quiet cell reads that cell's few events first. (sliding log)
* A fixed window only hands its end time on. Each (key, chunk of time) is therefore summarised in parallel as
  "window ends at E -> window ends at E'", the few summary rows are chained per key, and the chunks are then
  decided in parallel. A key that never pauses is still spread over all its chunks. (fixed window)
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens import fixed_values as fv

MICROS = 1_000_000
DECISION = "allowed boolean, remaining int, retry_after int"


def _timed(events: DataFrame, key: str, ts: str, order: str) -> DataFrame:
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    return events.select(F.col(key).alias("key"), F.col(order).alias("seq"), at.alias("at"))


def _schema(timed: DataFrame) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in timed.schema.fields}
    return f"key {kinds['key']}, seq {kinds['seq']}, at bigint, {DECISION}"


def _result(decided: DataFrame, key: str, ts: str, order: str) -> DataFrame:
    return decided.select(
        F.col("key").alias(key),
        F.col("seq").alias(order),
        F.timestamp_micros("at").alias(ts),
        "allowed",
        "remaining",
        "retry_after",
    )


# ---- sliding log ---------------------------------------------------------------------------


def slide(log: deque, at: int, limit: int, window: int) -> tuple[bool, int, int]:
    """Decide one event; `log` holds the accepted times of the trailing window and is updated."""
    while log and log[0] <= at - window:
        log.popleft()
    if len(log) >= limit:
        return False, 0, max(1, int((window - (at - log[0])) / MICROS))
    log.append(at)
    return True, limit - len(log), 0


def with_segment(timed: DataFrame, window: int, limit: int) -> DataFrame:
    """Adds `segment` and `known`: known rows are events of the quiet cell before the segment, accepted for certain.

    They are extra rows, at most `limit` for each segment.
    """
    celled = timed.withColumn("cell", F.floor(F.col("at") / window))
    by_key = Window.partitionBy("key").orderBy("cell")
    follows = F.coalesce(F.col("cell") - F.lag("cell").over(by_key) == 1, F.lit(False))
    before = F.when(follows, F.lag("n").over(by_key)).otherwise(F.lit(0))
    cells = celled.groupBy("key", "cell").agg(F.count("*").alias("n"))
    cells = cells.withColumns({"_follows": follows, "_quiet": F.col("n") + before <= limit})
    starts = ~F.col("_follows") | F.lag("_quiet").over(by_key)
    feeds = F.col("_quiet") & F.coalesce(F.lead("cell").over(by_key) == F.col("cell") + 1, F.lit(False))
    cells = cells.withColumns({"_start": F.when(starts, F.col("cell")), "_feeds": feeds})
    segment = F.last("_start", ignorenulls=True).over(by_key.rowsBetween(Window.unboundedPreceding, 0))
    cells = cells.select("key", "cell", "_feeds", segment.alias("segment"))
    own = F.struct("segment", F.lit(False).alias("known"))
    next_ = F.when(F.col("_feeds"), F.struct((F.col("cell") + 1).alias("segment"), F.lit(True).alias("known")))
    return celled.join(cells, ["key", "cell"]).select("key", "seq", "at", F.inline(F.array_compact(F.array(own, next_))))


def throttle_sliding(
    events: DataFrame,
    key: str = "user_id",
    ts: str = "ts",
    order: str = "event_id",
    limit: int = fv.THROTTLE_REQUESTS,
    seconds: int = fv.THROTTLE_SECONDS,
) -> DataFrame:
    """At most `limit` accepted events in any trailing window; rejected events do not count.

    A segment is read as a sorted stream of Arrow batches with at most `limit` times kept, never as a whole.
    """
    window = seconds * MICROS
    timed = _timed(events, key, ts, order)

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, log = None, deque()
        for batch in batches:
            out = []
            for owner, segment, at, known in zip(batch["key"], batch["segment"], batch["at"], batch["known"]):
                if (owner, segment) != current:
                    current, log = (owner, segment), deque()
                if known:
                    log.append(at)
                else:
                    out.append(slide(log, at, limit, window))
            yield decisions_of(batch[~batch["known"]], out)

    segments = with_segment(timed, window, limit).repartition("key", "segment").sortWithinPartitions("key", "segment", "at", "seq")
    return _result(segments.mapInPandas(decide, _schema(timed)), key, ts, order)


# ---- fixed window --------------------------------------------------------------------------


def _next_start(at: np.ndarray, window: int) -> np.ndarray:
    """For every event the position of the first event after its window, should it open one."""
    return np.searchsorted(at, at + window, side="left")


def _summary(at: np.ndarray, chunk_start: int, window: int) -> list[tuple[int, int]]:
    """(latest event that may open the chunk's first window, end of the chunk's last window) pairs.

    A window that is open when the chunk starts ends within it; the first event from then on opens the next.
    Neighbouring openings that lead to the same end are one pair.
    """
    after = _next_start(at, window)
    ends = at + window
    for i in range(len(at) - 1, -1, -1):
        if after[i] < len(at):
            ends[i] = ends[after[i]]
    reach = min(int(np.searchsorted(at, chunk_start + window, side="left")) + 1, len(at))
    first, ends = at[:reach], ends[:reach]
    last_of_run = np.flatnonzero(np.append(ends[1:] != ends[:-1], True))
    return [(int(first[i]), int(ends[i])) for i in last_of_run]


def count_in_window(state: tuple[int, int], at: int, limit: int, window: int) -> tuple[tuple[int, int], tuple]:
    """Decide one event; the state is (start of the window, events counted in it)."""
    opened, count = state
    if at >= opened + window:
        opened, count = at, 0
    count += 1
    if count <= limit:
        return (opened, count), (True, limit - count, 0)
    left = int((opened + window - at) / MICROS + 0.5)
    return (opened, count), (False, 0, left if left > 0 else window // MICROS)


def throttle_fixed(
    events: DataFrame,
    key: str = "user_id",
    ts: str = "ts",
    order: str = "event_id",
    limit: int = fv.THROTTLE_REQUESTS,
    seconds: int = fv.THROTTLE_SECONDS,
    chunk_seconds: int = 3600,
) -> DataFrame:
    """A window opens at a key's first event and lasts `seconds`; every event counts, those above `limit` fail."""
    window, chunk = seconds * MICROS, max(chunk_seconds, seconds) * MICROS
    timed = _timed(events, key, ts, order)
    chunked = timed.withColumn("chunk", F.floor(F.col("at") / chunk))
    kind = timed.schema["key"].dataType.simpleString()

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        for owner, number, at in _runs(batches):
            out += [(opens, ends, owner, number) for opens, ends in _summary(at, number * chunk, window)]
            if len(out) >= 10_000:
                yield pd.DataFrame(out, columns=["opens", "ends", "key", "chunk"])
                out = []
        yield pd.DataFrame(out, columns=["opens", "ends", "key", "chunk"])

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Start of the window that is open when each chunk begins, -1 for none."""
        owner, number, end, moved = None, None, -1, False
        for batch in batches:
            out = []
            for key_, chunk_, opens, ends in zip(batch["key"], batch["chunk"], batch["opens"], batch["ends"]):
                if key_ != owner:
                    owner, number, end = key_, None, -1
                if chunk_ != number:
                    number, moved = chunk_, False
                    out.append((owner, number, end - window if end > number * chunk else -1))
                if not moved and opens >= end:  # no such pair: the open window covers the whole chunk
                    end, moved = ends, True
            yield pd.DataFrame(out, columns=["key", "chunk", "opened"])

    in_chunks = chunked.repartition("key", "chunk").sortWithinPartitions("key", "chunk", "at", "seq")
    summaries = in_chunks.mapInPandas(summarise, f"opens bigint, ends bigint, key {kind}, chunk bigint")
    by_key = summaries.repartition("key").sortWithinPartitions("key", "chunk", "opens")
    openings = by_key.mapInPandas(chain, f"key {kind}, chunk bigint, opened bigint")
    # Events of the open window that lie in the chunks before; a window spans at most two chunks.
    spans = openings.filter("opened >= 0").select("key", (F.col("chunk") - 1).alias("chunk"), "opened")
    earlier = chunked.select("key", "chunk", "at").join(spans, ["key", "chunk"]).filter("at >= opened")
    held = earlier.groupBy("key", (F.col("chunk") + 1).alias("chunk")).agg(F.count("*").alias("held"))
    carried = openings.join(held, ["key", "chunk"], "left").fillna(0, ["held"])

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = None, (-window, 0)
        for batch in batches:
            out = []
            columns = (batch[c] for c in ("key", "chunk", "at", "opened", "held"))
            for owner, number, at, opened, before in zip(*columns):
                if (owner, number) != current:
                    current, state = (owner, number), (opened, before) if opened >= 0 else (-window, 0)
                state, decision = count_in_window(state, at, limit, window)
                out.append(decision)
            yield decisions_of(batch, out)

    known = chunked.join(carried, ["key", "chunk"]).repartition("key", "chunk")
    decided = known.sortWithinPartitions("key", "chunk", "at", "seq").mapInPandas(decide, _schema(timed))
    return _result(decided, key, ts, order)


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """(key, chunk, times) of every run of equal key and chunk in sorted batches; a run may span batches."""
    owner, number, parts = None, None, []
    for batch in batches:
        keys, chunks, at = batch["key"].to_numpy(), batch["chunk"].to_numpy(), batch["at"].to_numpy()
        cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (chunks[1:] != chunks[:-1])) + 1
        for start, stop in zip([0, *cuts], [*cuts, len(at)]):
            if start == stop:
                continue
            if parts and (keys[start] != owner or chunks[start] != number):
                yield owner, number, np.concatenate(parts)
                parts = []
            owner, number = keys[start], int(chunks[start])
            parts.append(at[start:stop])
    if parts:
        yield owner, number, np.concatenate(parts)


def decisions_of(batch: pd.DataFrame, decisions: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(decisions, columns=["allowed", "remaining", "retry_after"], index=batch.index)
    return pd.concat([batch[["key", "seq", "at"]], out], axis=1)
