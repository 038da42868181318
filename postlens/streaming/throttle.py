"""The throttles as stateful streams: a few numbers of state per key."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from postlens import fixed_values as fv
from postlens.operators.throttle import DECISION, MICROS, decisions_of, count_in_window, slide


def throttle_stream(
    events: DataFrame,
    kind: str,
    key: str = "user_id",
    ts: str = "ts",
    order: str = "event_id",
    limit: int = fv.THROTTLE_REQUESTS,
    seconds: int = fv.THROTTLE_SECONDS,
    lateness: str | None = None,
) -> DataFrame:
    """Decisions of a stream of events, `kind` is "fixed" or "sliding".

    Events are decided in order within a micro-batch; batches must arrive in time order. With a `lateness` ("10 minutes")
    a key's state goes one window after its last event, by event time, and events that are later than that behind the
    newest are dropped; without it every event is decided and the state of every key is kept.
    """
    window = seconds * MICROS
    at = F.col(ts).cast("timestamp")
    timed = events.select(F.col(key).alias("key"), F.col(order).alias("seq"), F.unix_micros(at).alias("at"), at.alias("event_time"))
    if lateness is not None:
        timed = timed.withWatermark("event_time", lateness)
    kinds = {f.name: f.dataType.simpleString() for f in timed.schema.fields}
    output = f"key {kinds['key']}, seq {kinds['seq']}, at bigint, {DECISION}"

    def decide(owner: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = state.get if state.exists else None
        log = deque(held[0]) if held else deque()
        fixed = (held[1], held[2]) if held else (-window, 0)
        rows = pd.concat(batches).sort_values(["at", "seq"], ignore_index=True)  # one key of one micro-batch
        out = []
        for at in rows["at"]:
            if kind == "sliding":
                out.append(slide(log, at, limit, window))
            else:
                fixed, decision = count_in_window(fixed, at, limit, window)
                out.append(decision)
        state.update(([int(a) for a in log], int(fixed[0]), int(fixed[1])))
        if lateness is not None:
            state.setTimeoutTimestamp((int(rows["at"].iloc[-1]) + window) // 1000 + 1)
        yield decisions_of(rows, out)

    timeout = GroupStateTimeout.NoTimeout if lateness is None else GroupStateTimeout.EventTimeTimeout
    decided = timed.groupBy("key").applyInPandasWithState(
        decide, output, "log array<bigint>, opened bigint, count bigint", "append", timeout
    )
    return decided.select(
        F.col("key").alias(key), F.col("seq").alias(order), F.timestamp_micros("at").alias(ts), "allowed", "remaining", "retry_after"
    )
