"""The per-machine patterns on a stream. State lives in the state store, a few values per machine.

Readings of a machine may come out of order by as much as the watermark allows. They wait in state until the watermark
has passed them, and are then handed on in order of time, so results do not depend on how the rows were cut into
micro-batches. Rows behind the watermark are dropped by the engine and counted in the query's progress
(`numRowsDroppedByWatermark`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import codes
from ..operators import holds
from ..operators.patterns import duration_micros, warning_message

# Rows of one entry of the waiting list.
CHUNK_ROWS = 65_536
# A time that is not there, in a column that has to stay whole numbers.
NO_TIME = -(2**63)


class OrderedProcessor(StatefulProcessor):
    """Collects a key's rows (`t` in microseconds, `order`, and more) and hands them to `follow` in order.

    With `clock="event"` rows wait for the watermark; otherwise they are handed on at once, in the order of the batch.
    """

    schema: str
    columns: list[str]

    def __init__(self, clock: str, sort: list[str]):
        self.clock, self.sort = clock, sort

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.schema)
        if self.clock == "event":
            self.waiting = handle.getListState("waiting", "chunk binary")
        if self.clock != "none":
            self.timer = handle.getValueState("timer", "at bigint")

    def follow(self, state: tuple | None, rows: pd.DataFrame, key, now: int | None) -> tuple[tuple | None, pd.DataFrame]:
        """The new state and the output after sorted `rows` (may be empty); nothing before `now` is to come."""
        raise NotImplementedError

    def due(self, state: tuple | None) -> int | None:
        """The first millisecond at which the state has something to say without further rows."""
        return None

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        out = self._advance(key, [part[self.columns] for part in rows], timerValues)
        if len(out):
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        fired = expiredTimerInfo.getExpiryTimeInMs()
        if self.timer.exists() and self.timer.get()[0] == fired:
            self.timer.clear()  # the engine takes a fired timer away by itself
            out = self._advance(key, [], timerValues)
            if len(out):
                yield out

    def close(self) -> None:
        pass

    def _advance(self, key, parts: list[pd.DataFrame], timerValues) -> pd.DataFrame:
        now = self._now(timerValues)
        ready, first_left = self._sorted_until(parts, now)
        before = tuple(self.state.get()) if self.state.exists() else None
        state, out = self.follow(before, ready, key[0], now)
        if state is None and before is not None:
            self.state.clear()
        elif state is not None and state != before:
            self.state.update(state)
        if self.clock != "none":
            times = [at for at in (first_left, self.due(state)) if at is not None]
            self._set_timer(min(times, default=None))
        return out

    def _now(self, timerValues) -> int | None:
        """In microseconds."""
        if self.clock == "event":
            return timerValues.getCurrentWatermarkInMs() * 1000
        if self.clock == "processing":
            return timerValues.getCurrentProcessingTimeInMs() * 1000
        return None

    def _sorted_until(self, parts: list[pd.DataFrame], now: int | None) -> tuple[pd.DataFrame, int | None]:
        """The rows up to the watermark in order; the rest goes on waiting, from the millisecond returned on."""
        if self.clock == "event" and self.waiting.exists():
            parts = [pa.ipc.open_stream(bytes(chunk)).read_pandas() for (chunk,) in self.waiting.get()] + parts
            self.waiting.clear()
        if not parts:
            return pd.DataFrame(), None
        rows = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0]
        rows = rows.iloc[np.lexsort([rows[c].to_numpy() for c in reversed(self.sort)])]
        if self.clock != "event":
            return rows, None
        cut = int(np.searchsorted(rows["t"].to_numpy(), now, side="right"))
        ready, left = rows.iloc[:cut], rows.iloc[cut:]
        if not len(left):
            return ready, None
        self.waiting.put([(packed(left.iloc[at : at + CHUNK_ROWS]),) for at in range(0, len(left), CHUNK_ROWS)])
        return ready, -(-int(left["t"].iloc[0]) // 1000)

    def _set_timer(self, at: int | None) -> None:
        old = self.timer.get()[0] if self.timer.exists() else None
        if at == old:
            return
        if old is not None:
            self.handle.deleteTimer(old)
        if at is None:
            self.timer.clear()
        else:
            self.timer.update((at,))
            self.handle.registerTimer(at)


def packed(rows: pd.DataFrame) -> bytes:
    batch = pa.RecordBatch.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


class HoldProcessor(OrderedProcessor):
    """`hold_alerts` of one key. A timer raises the alert when no further reading does."""

    schema = "start bigint, last bigint"
    columns = ["t", "order", "match"]

    def __init__(self, hold: int, clock: str):
        super().__init__(clock, ["t", "order"])
        self.hold = hold

    def due(self, state: tuple | None) -> int | None:
        return None if state is None else (state[0] + self.hold) // 1000 + 1

    def follow(self, state, rows, key, now):
        start, last = state or (None, None)
        alerts: list[tuple] = []
        if len(rows):
            t, match = rows["t"].to_numpy(), rows["match"].to_numpy(dtype=bool)
            alerts, start, last = holds.walk(t, ~match, match, self.hold, start, last)
        if start is not None and start + self.hold < now:
            alerts = [*alerts, (start + self.hold, last)]
            start = None
        out = pd.DataFrame([(key, int(alert), int(seen)) for alert, seen in alerts], columns=["key", "alert", "last"])
        return (None if start is None else (int(start), int(last))), out


class TransitionProcessor(OrderedProcessor):
    """`transitions_to_running` of one machine."""

    schema = "status string, changes bigint"
    columns = ["t", "order", "status"]

    def follow(self, state, rows, key, now):
        status, changes = state or (None, 0)
        if not len(rows):
            return state, pd.DataFrame()
        now_status = rows["status"].to_numpy(dtype=object)
        previous = np.concatenate([np.array([status], dtype=object), now_status[:-1]])
        started = (now_status == codes.RUNNING) & (previous != codes.RUNNING) & ~pd.isna(previous)
        counts = changes + np.cumsum(started)
        out = pd.DataFrame({
            "arrival": rows["order"].to_numpy()[started],
            "machine_id": np.full(started.sum(), key, dtype=object),
            "previous": previous[started],
            "changes": counts[started].astype(np.int64),
            "t": rows["t"].to_numpy()[started],
        })
        last = now_status[-1]
        return (None if pd.isna(last) else last, int(counts[-1])), out


def stream_hold_alerts(
    df: DataFrame,
    condition: Column,
    hold: str,
    *,
    key: str = "machine_id",
    time: str = "arrival_ts",
    order: str = "arrival",
    delay: str = "0 seconds",
    clock: str = "event",
) -> DataFrame:
    """`hold_alerts` on a stream.

    With `clock="event"` readings wait until the watermark on `time` (the latest time seen, less `delay`) has passed
    them, so readings out of order by up to `delay` give the alerts of the batch. The watermark stands for the end of
    the data seen so far: a silent machine alerts once any machine has reported later than its deadline, and a replay
    gives the same alerts. With `clock="processing"` readings are taken at once and a hold alerts when the wall clock
    passes its deadline, also if all machines are silent; that is for live lines whose `time` is their arrival time.
    """
    if clock not in ("event", "processing"):
        raise ValueError(f"clock: {clock}")
    timed = df.withWatermark(time, delay) if clock == "event" else df
    readings = timed.where(F.col(time).isNotNull()).select(
        F.col(key).alias("key"),
        F.col(time).alias("time"),
        F.unix_micros(time).alias("t"),
        F.col(order).alias("order"),
        F.coalesce(condition, F.lit(False)).alias("match"),
    )
    alerts = readings.groupBy("key").transformWithStateInPandas(
        HoldProcessor(duration_micros(hold), clock), "key string, alert bigint, last bigint", "append", f"{clock}Time"
    )
    return alerts.select(
        F.col("key").alias(key),
        F.timestamp_micros("alert").alias("alert_time"),
        F.timestamp_micros("last").alias("last_match_time"),
    )


def stream_warning_held(changes: DataFrame, hold: str = codes.WARNING_HOLD, *, time: str = "start_time", **options):
    alerts = stream_hold_alerts(changes, F.col("status") == codes.WARNING, hold, time=time, **options)
    return alerts.withColumn("message", warning_message(duration_micros(hold) // 1_000_000))


def stream_temperature_held(environment: DataFrame, hold: str = codes.TEMPERATURE_HOLD, **options) -> DataFrame:
    return stream_hold_alerts(environment, F.col("temperature") > codes.TEMPERATURE_LIMIT, hold, **options)


def stream_transitions(
    changes: DataFrame, *, time: str = "arrival_ts", order: str = "arrival", delay: str | None = None
) -> DataFrame:
    """`transitions_to_running` on a stream.

    Without `delay` the rows of a micro-batch are taken at once, in order of arrival. With one, they wait for the
    watermark on `time` and are taken in order of (`time`, `order`), so rows late by up to `delay` find their place.
    """
    timed = changes if delay is None else changes.withWatermark(time, delay).where(F.col(time).isNotNull())
    rows = timed.select(
        "machine_id",
        "status",
        F.col(order).alias("order"),
        F.col(time).alias("time"),
        F.coalesce(F.unix_micros(time), F.lit(NO_TIME)).alias("t"),
    )
    processor = TransitionProcessor("none", ["order"]) if delay is None else TransitionProcessor("event", ["t", "order"])
    found = rows.groupBy("machine_id").transformWithStateInPandas(
        processor,
        f"arrival {dict(changes.dtypes)[order]}, machine_id string, previous string, changes bigint, t bigint",
        "append",
        "none" if delay is None else "eventTime",
    )
    return found.select(
        "arrival", "machine_id", "previous", "changes",
        F.when(F.col("t") != NO_TIME, F.timestamp_micros("t")).alias("change_time"),
    )
